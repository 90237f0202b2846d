"""Predicates: half-open time filter (PR9) and row rules that drop violations (PR13)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _bound(df: DataFrame, column: str, value) -> Column:
    """A literal of the column's own timestamp type, independent of the session zone.

    Naive ``datetime`` values are UTC wall-clock times (the library's convention):
    for TIMESTAMP_NTZ they become an NTZ literal, for TIMESTAMP the UTC instant.
    Without this, a naive ``datetime`` becomes an instant in the Python process's
    zone and is shifted when compared with an NTZ column in another session zone.
    """
    if not isinstance(value, datetime):
        return F.lit(value)
    dt = df.schema[column].dataType
    utc = value.astimezone(timezone.utc) if value.tzinfo else value.replace(tzinfo=timezone.utc)
    if isinstance(dt, T.TimestampNTZType):
        return F.lit(utc.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(dt, T.TimestampType):
        return F.lit(utc)
    return F.lit(value)


def filter_by_ts(df: DataFrame, ts_column: str | None, start=None, end=None) -> DataFrame:
    """Keep rows with ``start <= ts < end``; each bound optional; no-op without a column.

    Plain comparisons with a literal of the column's type, so Catalyst pushes them to
    the parquet scan as row-group filters.
    """
    if ts_column and start is not None:
        df = df.filter(F.col(ts_column) >= _bound(df, ts_column, start))
    if ts_column and end is not None:
        df = df.filter(F.col(ts_column) < _bound(df, ts_column, end))
    return df


def sample_range(df: DataFrame, ts_column: str, start=None, end=None, fraction: float = 0.1, seed: int | None = None,
                 key: list[Column] | None = None) -> DataFrame:
    """ML12: a random subsample of the rows inside ``[start, end)``, no shuffle.

    A row is in the sample by the MD5 of the seed and its ``key`` (by default all its columns), so the same
    rows come back on any cluster, after any retry, and from any other engine; equal rows go together.
    """
    rows = filter_by_ts(df, ts_column, start, end)
    key = key if key is not None else [F.col(c).cast("string") for c in df.columns]
    text = F.concat_ws("|", F.lit(str(seed or 0)), *[F.coalesce(c.cast("string"), F.lit("")) for c in key])
    bound = format(min(int(fraction * (1 << 32)), (1 << 32) - 1), "08x")
    return rows.where(F.substring(F.md5(text), 1, 8) < F.lit(bound))


@dataclass(frozen=True)
class Rule:
    """``CONSTRAINT name EXPECT (predicate) ON VIOLATION DROP ROW``.

    A NULL predicate counts as a violation (the row is dropped).
    """

    name: str
    predicate: str | Column

    def column(self) -> Column:
        return F.expr(self.predicate) if isinstance(self.predicate, str) else self.predicate


def apply_rules(df: DataFrame, rules: list[Rule], observation_name: str | None = None) -> DataFrame:
    """Drop rows that violate any rule, counting rows seen, rows dropped and violations per rule.

    Counts are gathered with ``DataFrame.observe`` in the same pass as the data
    (no second job); in a stream they arrive per micro-batch in
    ``StreamingQueryProgress.observedMetrics[observation_name]``.
    """
    if not rules:
        return df
    passed = [F.coalesce(r.column(), F.lit(False)) for r in rules]
    keep = passed[0]
    for ok in passed[1:]:
        keep = keep & ok
    if observation_name:
        metrics = [
            F.count(F.lit(1)).alias("rows_seen"),
            F.sum(F.when(keep, 0).otherwise(1)).alias("rows_dropped"),
        ]
        for r, ok in zip(rules, passed):
            metrics.append(F.sum(F.when(ok, 0).otherwise(1)).alias(f"violations_{r.name}"))
        df = df.observe(observation_name, *metrics)
    return df.filter(keep)
