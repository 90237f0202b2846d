"""Catalog helpers: replace a table with a source table (SK13)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){0,2}$")


def replace_table_from_source(
    spark: SparkSession,
    table_name: str,
    source_path: str,
    source_name: str | None = None,
    fmt: str = "parquet",
    copy: bool = False,
) -> DataFrame:
    """Make ``table_name`` hold the table stored at ``source_path/source_name``.

    ``source_name`` defaults to ``table_name``.  Without ``copy`` this is zero-copy:
    a temporary view over the source files (the closest plain-parquet analogue of
    a shallow clone).  With ``copy`` the rows are written as a managed table.
    """
    if not _NAME.match(table_name):
        raise ValueError(f"bad table name {table_name!r}")
    src = f"{source_path.rstrip('/')}/{source_name or table_name.split('.')[-1]}"
    df = spark.read.format(fmt).load(src)
    if copy:
        df.write.mode("overwrite").saveAsTable(table_name)
        return spark.table(table_name)
    df.createOrReplaceTempView(table_name.split(".")[-1])
    return spark.table(table_name.split(".")[-1])
