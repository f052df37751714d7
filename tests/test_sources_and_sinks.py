import json
from datetime import date
from types import SimpleNamespace

import pytest
from conftest import rows_of

from jobmetrics import schemas
from jobmetrics.operators.numbering import with_surrogate
from jobmetrics.plans.fact import build_fact
from jobmetrics.session import FIRST_SHUFFLE, SHUFFLE, prepare, scratch_path, size_shuffles
from jobmetrics.sinks import catalog, fact_lake, topic as topic_sink, warehouse
from jobmetrics.sources import csv, jdbc, tables, topic
from jobmetrics.sources.fixtures import messages


def test_column_names_match_parsed_layouts(spark):
    for ddl, _ in schemas.TABLES.values():
        assert schemas.column_names(ddl) == schemas.struct(spark, ddl).names
    # Number of columns of each table.
    sizes = {name: len(schemas.column_names(ddl)) for name, (ddl, _) in schemas.TABLES.items()}
    assert sizes == {"tracking": 29, "events": 16, "campaign": 22, "company": 18,
                     "job_group": 12, "job": 30, "publisher": 20, "tracking_summary": 5}


def test_ensure_tables_and_schema_check(spark):
    catalog.ensure_tables(spark, "warehouse_test")
    spark.sql("insert into warehouse_test.tracking_summary values ('k', 1.0, 'b', 2, 3)")
    catalog.ensure_tables(spark, "warehouse_test")
    assert spark.table("warehouse_test.tracking_summary").count() == 1
    described = catalog.describe(spark, "warehouse_test")
    assert set(described) == set(schemas.TABLES)
    for name, (ddl, _) in schemas.TABLES.items():
        assert schemas.schema_check(spark.table(f"warehouse_test.{name}"), ddl) == []


def test_schema_check_reports_differences(spark):
    df = spark.createDataFrame([], "create_time string, bid string, extra int")
    assert schemas.schema_check(df, "create_time STRING, bid DOUBLE, bn STRING") == [
        "missing column bn", "unexpected column extra", "column bid is string, declared double"
    ]


def test_table_reads_declared_columns(spark, tracking, tmp_path):
    path = str(tmp_path / "tracking")
    tracking.write.parquet(path)
    table = tables.Table("parquet", {"path": path})
    assert table.load(spark, tables.TRACKING_COLUMNS).columns == tables.TRACKING_COLUMNS
    store = tables.cassandra_table("lake", "tracking")
    assert store.format == "org.apache.spark.sql.cassandra"
    assert store.options == {"keyspace": "lake", "table": "tracking"}


def test_csv_round_trip_and_rejects(spark, tracking, tmp_path):
    path = str(tmp_path / "csv")
    rows = tracking.select(*schemas.column_names(schemas.MESSAGE))
    rows.write.option("header", True).csv(path)
    assert rows_of(csv.csv_load(spark, path)) == rows_of(rows)
    assert csv.csv_rejects(spark, path).count() == 0
    broken = tmp_path / "broken.csv"
    header = ",".join(schemas.column_names(schemas.MESSAGE))
    broken.write_text(
        f"{header}\na,1.5,1,click,1,1,1,t\nb,many,1,click,1,1,1,t\nc,1,1,click\n"
        "d,1,1,click,1,1,1,t,surplus\n"
    )
    good, bad = csv.csv_load(spark, str(broken)), csv.csv_rejects(spark, str(broken))
    assert [r["create_time"] for r in good.collect()] == ["a"]
    # Also where the reader could skip columns.
    assert good.count() == 1 and good.select("ts").count() == 1
    assert [r[0] for r in good.select("ts").collect()] == ["t"]
    assert {r["create_time"] for r in bad.collect()} == {"b", "c", "d"} and bad.count() == 3


def test_csv_with_other_columns_is_refused(spark, tmp_path):
    path = tmp_path / "other.csv"
    path.write_text("bid,create_time,c,d,e,f,g,h\n1,a,1,1,1,1,1,1\n")
    with pytest.raises(Exception, match="CSV header|CSV_HEADER"):
        csv.csv_load(spark, str(path)).collect()


def test_jdbc_options():
    target = jdbc.JdbcTarget("jdbc:mysql://db:3306/warehouse", "com.mysql.cj.jdbc.Driver", "u", "p")
    plain = jdbc.subquery_options(target, jdbc.newest_query("events", "updated_at"))
    assert plain["dbtable"] == "(SELECT MAX(updated_at) AS max_ts FROM events) t"
    assert "partitionColumn" not in plain and plain["user"] == "u"
    query = jdbc.dimension_query("company", "company_id", "name")
    assert query == "SELECT id AS company_id, name FROM company"
    split = jdbc.subquery_options(target, query, jdbc.Split("company_id", 1, 10**6, 32))
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"],
            split["numPartitions"]) == ("company_id", "1", "1000000", "32")


def test_write_fact_jdbc_options():
    target = jdbc.JdbcTarget("jdbc:mysql://db:3306/warehouse", "com.mysql.cj.jdbc.Driver", "u", "p")
    written = warehouse.jdbc_write_options(target, "events", 8)
    assert (written["dbtable"], written["numPartitions"], written["batchsize"]) == (
        "events", "8", "10000"
    )
    assert warehouse.GENERATED == ["id", "updated_at"]


def test_topic_options():
    options = topic.topic_options("kafka:9092", "tracking")
    assert options == {"kafka.bootstrap.servers": "kafka:9092", "subscribe": "tracking",
                       "startingOffsets": "earliest"}
    latest = topic.topic_options("kafka:9092", "tracking", startingOffsets="latest", maxOffsetsPerTrigger="9")
    assert latest == options | {"startingOffsets": "latest", "maxOffsetsPerTrigger": "9"}
    pattern = topic.topic_options("kafka:9092", subscribePattern="track.*")
    assert "subscribe" not in pattern and pattern["subscribePattern"] == "track.*"
    for wrong in ({}, {"topic": "a", "subscribePattern": "b"}):
        with pytest.raises(ValueError):
            topic.topic_options("kafka:9092", **wrong)


def test_days_are_swapped_in_one_transaction():
    days = [date(2024, 1, 2), date(2024, 1, 1)]
    assert warehouse.swap_statements("events", "events_staging", ["job_id", "dates"], days) == [
        "DELETE FROM events WHERE dates IN (DATE '2024-01-01', DATE '2024-01-02')",
        "INSERT INTO events (job_id, dates) SELECT job_id, dates FROM events_staging",
    ]


def test_only_the_days_loaded_are_published(spark, tracking, job_dim, monkeypatch):
    """What would go to the warehouse; no database is run here."""
    written, run = [], []
    monkeypatch.setattr(warehouse, "replace_fact_jdbc", lambda rows, t, table, n: written.append((rows, table)))
    monkeypatch.setattr(warehouse, "run_in_transaction", lambda spark, t, statements: run.extend(statements))
    target = jdbc.JdbcTarget("jdbc:mysql://db:3306/warehouse", "com.mysql.cj.jdbc.Driver", "u", "p")
    fact, days = build_fact(tracking, job_dim), [date(2024, 1, 3), date(2024, 2, 9)]
    warehouse.publish_days(fact, target, days)
    (rows, table), = written
    assert table == "events_staging" and rows_of(rows) == rows_of(fact.filter("dates = date'2024-01-03'"))
    assert len(run) == 2 and "2024-02-09" in run[0]
    warehouse.publish_days(fact, target, [])
    assert len(written) == 1


def test_the_fact_is_a_table_of_the_catalog(spark, tracking, job_dim, tmp_path):
    path = str(tmp_path / "facts")
    fact = with_surrogate(build_fact(tracking, job_dim))
    early = fact.filter("dates < date'2024-01-10'")
    spark.sql("create database if not exists fact_test")
    for rows in (early, fact):
        fact_lake.replace_fact(rows, path)
        catalog.ensure_fact(spark, "fact_test.events", path)
        assert spark.table("fact_test.events").count() == rows.count()
    columns = {f.name: f.dataType for f in spark.table("fact_test.events").schema}
    assert columns == {f.name: f.dataType for f in schemas.struct(spark, schemas.FACT)}
    fact_lake.replace_days(fact.filter("false"), path, [date(2024, 1, 3)])
    catalog.ensure_fact(spark, "fact_test.events", path)
    assert spark.table("fact_test.events").count() == fact.filter("dates <> date'2024-01-03'").count()


def test_shuffles_start_by_the_size_of_the_input():
    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    session = SimpleNamespace(conf=Conf({SHUFFLE: "200"}))
    assert size_shuffles(session, 10 << 30) == 200 and FIRST_SHUFFLE not in session.conf
    assert size_shuffles(session, 100 << 40) == 819200 and session.conf[FIRST_SHUFFLE] == "819200"


def test_csv_rejects_keep_the_whole_record(spark, tmp_path):
    path = tmp_path / "odd.csv"
    header = ",".join(schemas.column_names(schemas.MESSAGE))
    path.write_text(f'{header}\nd,1,1,click,1,1,1,t,surplus,more\nb,many,1,click,1,1,1,t\n')
    raw = {r["create_time"]: r["raw"] for r in csv.csv_rejects(spark, str(path)).collect()}
    assert raw == {"d": "d,1,1,click,1,1,1,t,surplus,more", "b": "b,many,1,click,1,1,1,t"}
    path.write_text(f'{header}\na,1,1,"cli\nck",1,1,1,t\n')
    row, = csv.csv_load(spark, str(path), multi_line=True).collect()
    assert row["custom_track"] == "cli\nck"


def test_messages_write_missing_fields_as_null(spark, tracking):
    value = topic_sink.events_to_json(tracking.filter("event_id = 0")).first()["value"]
    sent = json.loads(value)
    assert list(sent) == schemas.column_names(schemas.MESSAGE)
    assert sent["job_id"] is None and sent["bid"] is None and sent["create_time"]


def test_fixture_messages_are_json_for_other_readers(tracking):
    for row in messages(tracking).filter("event_id % 101 != 0").limit(200).collect():
        assert set(json.loads(row["value"])) == set(schemas.column_names(schemas.MESSAGE))


def test_shuffle_partitions_follow_the_cluster():
    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    def first(cores, **conf):
        settings = Conf({SHUFFLE: "200"} | conf)
        prepare(SimpleNamespace(
            conf=settings, sparkContext=SimpleNamespace(defaultParallelism=cores)
        ))
        return settings.get(FIRST_SHUFFLE)

    assert first(8) == "200"
    assert first(4000) == "16000"
    assert first(4000, **{SHUFFLE: "9000"}) is None
    assert first(4000, **{FIRST_SHUFFLE: "5000"}) == "5000"


def test_scratch_is_in_the_shared_folder():
    def session(**conf):
        return SimpleNamespace(conf=conf)

    shared = session(**{"spark.checkpoint.dir": "hdfs://shared/checkpoints/"})
    path = scratch_path(shared, "x")
    assert path.startswith("hdfs://shared/checkpoints/jobmetrics/x-")
    assert path != scratch_path(shared, "x")
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            scratch_path(session(**{"spark.master": master}), "x")
    assert scratch_path(session(**{"spark.master": "local[4]"}), "x")
