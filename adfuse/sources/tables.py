"""Typed access to the source tables the derived feeds are built from.

Declaring the schema avoids a schema-inference job (footer read) on every
plan; columns are still resolved by name and pruned to what a query needs.
Integer columns are declared BIGINT: the parquet reader widens 32-bit
columns, so either physical width reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The source tables' column names and types.
TABLE_SCHEMAS: dict[str, str] = {
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber BIGINT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
        "value DOUBLE, props STRING"
    ),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream.

    ``name.parquet`` may be a folder (new files in it are picked up) or one
    file; the pattern matches exactly this name.
    """
    base = sf_dir.rstrip("/")
    return (
        spark.readStream.schema(TABLE_SCHEMAS[name])
        .option("basePath", base)
        .parquet(f"{base}/{{{name}.parquet}}")
    )
