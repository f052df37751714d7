"""The fact in the warehouse, over JDBC."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobmetrics.sources.jdbc import JdbcTarget

# Filled by the database: the key counts up, the load time defaults to now.
GENERATED = ["id", "updated_at"]


def jdbc_write_options(
    target: JdbcTarget, table: str, connections: int, batch_rows: int = 10000
) -> dict[str, str]:
    """``connections`` bounds the parallel sessions whatever the number of partitions."""
    return target.options(
        dbtable=table, batchsize=str(batch_rows), numPartitions=str(connections)
    )


def write_fact_jdbc(
    fact: DataFrame, target: JdbcTarget, table: str = "events", connections: int = 16
) -> None:
    """Insert the rows into an existing table, by column name.

    Each partition is one transaction, but a retried task may insert its rows again. Load an
    empty staging table and swap it inside the database where that matters.
    """
    rows = fact.drop(*GENERATED)
    options = jdbc_write_options(target, table, connections)
    rows.write.format("jdbc").options(**options).mode("append").save()


def replace_fact_jdbc(
    fact: DataFrame, target: JdbcTarget, table: str = "events", connections: int = 16
) -> None:
    """Empty the table, keeping its definition, and fill it again."""
    options = jdbc_write_options(target, table, connections) | {"truncate": "true"}
    rows = fact.drop(*GENERATED)
    rows.write.format("jdbc").options(**options).mode("overwrite").save()


def swap_statements(table: str, staging: str, columns: Sequence[str], days: Collection[date]) -> list[str]:
    """What replaces days of ``table`` by the rows of ``staging``, in one transaction."""
    names = ", ".join(columns)
    listed = ", ".join(f"DATE '{day.isoformat()}'" for day in sorted(days))
    return [
        f"DELETE FROM {table} WHERE dates IN ({listed})",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}",
    ]


def publish_days(
    fact: DataFrame, target: JdbcTarget, days: Collection[date], table: str = "events",
    staging: str | None = None, connections: int = 16,
) -> None:
    """Bring only some days of the warehouse up to date, those without rows included.

    Their rows fill the staging table first, over parallel sessions; a task that is repeated
    belongs to a write that starts from an empty table. Then one transaction deletes the days
    and inserts the staged rows, so that readers see the days before or after, never between.
    """
    if not days:
        return
    staging = staging or f"{table}_staging"
    rows = fact.filter(F.col("dates").isin(list(days))).drop(*GENERATED)
    replace_fact_jdbc(rows, target, staging, connections)
    run_in_transaction(fact.sparkSession, target, swap_statements(table, staging, rows.columns, days))


def run_in_transaction(spark: SparkSession, target: JdbcTarget, statements: Sequence[str]) -> None:
    """Run statements over one session of the driver, all or none."""
    manager = spark._jvm.java.sql.DriverManager
    spark._jvm.java.lang.Class.forName(target.driver)
    session = manager.getConnection(target.url, target.user, target.password)
    try:
        session.setAutoCommit(False)
        for statement in statements:
            session.createStatement().execute(statement)
        session.commit()
    except Exception:
        session.rollback()
        raise
    finally:
        session.close()
