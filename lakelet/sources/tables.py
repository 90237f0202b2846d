"""Batch scans: by path, by path in SQL, by name; inline rows; file inventory."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

PREVIEW_ROWS = 1000  # fixed value: the notebook preview shows at most 1000 rows

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


def read_path(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """SC1: lazy scan of a table stored at ``path`` (format is a parameter; Delta needs its jar)."""
    return spark.read.format(fmt).options(**options).load(path)


def read_path_sql(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SC2: ``SELECT * FROM fmt.`path```; the same scan through the SQL front end."""
    if "`" in path:
        raise ValueError("backtick in path")
    return spark.sql(f"SELECT * FROM {_ident(fmt)}.`{path}`")


def read_name(spark: SparkSession, name: str) -> DataFrame:
    """SC3: table or view by a one-, two- or three-part name."""
    return spark.table(name)


def sf_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's generated tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def values_view(spark: SparkSession, view: str, columns: Sequence[str], rows: Sequence[Sequence]) -> DataFrame:
    """SC10: ``CREATE OR REPLACE TEMP VIEW view(cols) AS VALUES (...)``, values bound as parameters."""
    cols = ", ".join(_ident(c) for c in columns)
    args: dict = {}
    tuples = []
    for i, row in enumerate(rows):
        if len(row) != len(columns):
            raise ValueError("row width differs from the column list")
        names = []
        for j, v in enumerate(row):
            key = f"v{i}_{j}"
            args[key] = v
            names.append(f":{key}")
        tuples.append("(" + ", ".join(names) + ")")
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {_ident(view)}({cols}) AS VALUES " + ", ".join(tuples), args)
    return spark.table(view)


def number_sequence(spark: SparkSession, n: int) -> DataFrame:
    """SC11: a column ``id`` holding 0..n-1, generated in parallel."""
    return spark.range(n)


def file_inventory(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """SC12: the files under ``path`` as a table (path, modificationTime, length).

    The ``binaryFile`` source lists files on the executors; selecting only these
    columns keeps the file contents unread.
    """
    df = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    return df.select("path", "modificationTime", "length")


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """SK14: at most ``n`` rows, as a notebook preview shows."""
    return df.limit(n)


def literal_row(spark: SparkSession, sql: str) -> DataFrame:
    """SC13: a one-row select without FROM, e.g. ``SELECT 'hello' AS greeting``."""
    return spark.sql(sql)

