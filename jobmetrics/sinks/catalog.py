"""Tables in the catalog."""

from __future__ import annotations

from pyspark.sql import SparkSession

from jobmetrics import schemas


def ensure_tables(spark: SparkSession, database: str = "default") -> None:
    """Create every declared table that does not exist; existing ones are left alone."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (ddl, partitions) in schemas.TABLES.items():
        by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({ddl}) USING parquet{by}")


def ensure_fact(spark: SparkSession, table: str, path: str) -> None:
    """Make the stored fact a table of the catalog, and register the days it has by now."""
    columns = [f"{f.name} {f.dataType.simpleString()}" for f in schemas.struct(spark, schemas.FACT)]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}) USING parquet "
              f"PARTITIONED BY (dates) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def describe(spark: SparkSession, database: str = "default") -> dict[str, list[str]]:
    """Columns of every table of a database."""
    return {
        t.name: [c.name for c in spark.catalog.listColumns(f"{database}.{t.name}")]
        for t in spark.catalog.listTables(database)
        if not t.isTemporary
    }
