"""Keyed, partitioned feature tables on plain parquet (SK9-SK11, SK13, JN3, ML1, ML10).

Layout under one root folder (by default ``<spark.checkpoint.dir>/lakelet/feature_store``):

* ``tables/<name>-<id>/`` -- the data, partitioned as declared, in folders that a
  manifest publishes (``versions``): a change is visible whole or not at all
* ``_meta/`` -- one parquet row per table version: keys, partitions, description,
  schema, row count.  Discovery (ML10) is a query over it.
* ``_staging/`` -- new batches are written here first, which cuts their lineage.

There is no MERGE on parquet; the keyed upsert unites the batch with the partitions it
touches, groups by key (one exchange checks and merges) and publishes the rewritten
partitions, so its cost follows the size of the change rather than of the table.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelet.operators.joins import hot_keys, key_hash
from lakelet.session import shared_dir
from lakelet.store.versions import ZERO, ConcurrentWriteError, VersionedTable, ensure_table

_META_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("primary_keys", T.ArrayType(T.StringType())),
        T.StructField("partition_columns", T.ArrayType(T.StringType())),
        T.StructField("description", T.StringType()),
        T.StructField("schema_json", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("version", T.LongType()),
        T.StructField("written_at", T.TimestampType()),
        # {partition column: SQL expression over the key columns}, when partitions follow keys
        T.StructField("partition_expr_json", T.StringType()),
        T.StructField("buckets", T.IntegerType()),  # by the keys; null: none
    ]
)

class DuplicateKeyError(ValueError):
    pass


def _null_safe_keys(left: DataFrame, right: DataFrame, keys: list[str]):
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def _partition_filter(partition_columns: list[str], touched: list[tuple]):
    """Null-safe filter on the touched partition values (a NULL value is a partition too);
    a plain IN-list where possible so that it prunes directories."""
    if len(partition_columns) == 1:
        col = F.col(partition_columns[0])
        values = [t[0] for t in touched if t[0] is not None]
        cond = col.isin(values) if values else None
        if len(values) < len(touched):
            cond = col.isNull() if cond is None else cond | col.isNull()
        return cond
    cond = None
    for t in touched:
        c = None
        for name, v in zip(partition_columns, t):
            e = F.col(name).eqNullSafe(F.lit(v))
            c = e if c is None else c & e
        cond = c if cond is None else cond | c
    return cond


def touched_partitions(
    table: VersionedTable, batch: DataFrame, keys: list[str], partition_expr: dict[str, str] | None = None
) -> list[tuple]:
    """Partition values that a merge of ``batch`` must rewrite (bounded by the partitions, not by rows).

    A key may not sit in two partitions.  Where partition columns are key columns, or are computed from
    them by a recorded expression (verified here on every row), a key never moves and the batch's own
    partitions are enough.  Else the partitions in which the batch's keys sit now belong to it, too.
    """
    parts = table.parts
    cols = [F.col(p) for p in parts]
    if partition_expr:
        wrong = F.max(F.when(~F.expr(" AND ".join(f"({e}) <=> `{c}`" for c, e in partition_expr.items())), 1).otherwise(0))
        seen = batch.groupBy(*parts).agg(wrong.alias("_wrong")).collect()
        if any(r["_wrong"] for r in seen):
            raise ValueError(f"rows of the batch are not in the partition that {partition_expr} gives")
        return [tuple(r[p] for p in parts) for r in seen]
    touched = {tuple(r) for r in batch.select(*cols).distinct().collect()}
    if touched and not set(parts) <= set(keys):
        old = table.read()
        moved = old.join(batch.select(*keys), _null_safe_keys(old, batch, keys), "left_semi").select(*cols).distinct()
        touched |= {tuple(r) for r in moved.collect()}
    return list(touched)


def merge_versioned(
    table: VersionedTable, batch: DataFrame, keys: list[str], partition_expr: dict[str, str] | None = None
) -> None:
    """SK10: keyed upsert of ``batch`` (already written somewhere, it is scanned twice).

    One exchange on the keys serves check and merge: old rows of the touched partitions and the batch are
    united with a source flag and grouped by key; the batch's row wins, and a key that the batch holds
    twice stops the merge before anything is published.  Keys compare null-safe, as in any grouping.
    """
    cols = table.schema.fieldNames()
    base = table.snapshot()
    old = table.read(base)
    if table.parts:
        touched = touched_partitions(table, batch, keys, partition_expr)
        if not touched:
            return
        old = old.where(_partition_filter(table.parts, touched))
    united = old.select(*cols, F.lit(0).alias("_new")).unionByName(batch.select(*cols, F.lit(1).alias("_new")))
    row = F.struct(*[F.col(c) for c in cols])
    grouping = table.grouping(keys)
    merged = table.clustered(united).groupBy(*grouping).agg(F.max_by(row, "_new").alias("_row"), F.sum("_new").alias("_n"))
    obs = Observation(f"merge_{uuid.uuid4().hex[:8]}")
    # keys as they were grouped: the writer sees that rows are in their buckets' places
    rest = [F.col("_row")[c].alias(c) for c in cols if c not in keys]
    written = table.write(merged.observe(obs, F.max("_n").alias("most")).select(*grouping, *rest))
    if (obs.get["most"] or 0) > 1:
        table.discard(written)
        raise DuplicateKeyError(f"duplicate primary keys {keys}")
    keep = base.entries if table.parts else {}
    if table.parts and not set(table.parts) <= set(keys) and not partition_expr:
        # a partition whose last key moved away has no file in the new folder: it is gone
        gone = {e for e in keep if e not in written and e in _partition_names(keep, touched)}
        keep = {e: f for e, f in keep.items() if e not in gone}
    try:
        table.publish({**keep, **written}, base)
    except ConcurrentWriteError:
        table.discard(written)
        raise


def _partition_names(entries: dict[str, str], touched: list[tuple]) -> set[str]:
    """Folder names of partition values, as the live table spells them."""
    from urllib.parse import unquote

    def spelt(name: str) -> tuple:
        return tuple(None if (v := unquote(x.split("=", 1)[1])) == "__HIVE_DEFAULT_PARTITION__" else v for x in name.split("/"))

    wanted = {tuple(None if v is None else str(v) for v in t) for t in touched}
    return {e for e in entries if spelt(e) in wanted}


@dataclass(frozen=True)
class FeatureLookup:
    """Which features to take from a table, and which input columns are its keys (in key order)."""

    table_name: str
    feature_names: list[str]
    lookup_key: list[str]


@dataclass
class TrainingSet:
    """Raw rows + looked-up features, label, excluded columns (ML1)."""

    df: DataFrame
    feature_lookups: list[FeatureLookup]
    label: str | None
    exclude_columns: list[str] = field(default_factory=list)

    def load_df(self) -> DataFrame:
        return self.df.drop(*self.exclude_columns)

    def spec_json(self) -> str:
        return json.dumps(
            {
                "feature_lookups": [asdict(x) for x in self.feature_lookups],
                "label": self.label,
                "exclude_columns": list(self.exclude_columns),
            }
        )


class FeatureStore:
    """Feature tables by name: create, upsert, read, look up, discover."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or shared_dir(spark, "feature_store")).rstrip("/")
        self.meta_path = f"{self.root}/_meta"
        self._specs: dict[str, dict] = {}  # latest spec of tables this instance wrote or read
        ensure_table(spark, self.meta_path, _META_SCHEMA)

    # ---- metadata -------------------------------------------------------
    def _meta(self) -> DataFrame:
        return self.spark.read.schema(_META_SCHEMA).parquet(self.meta_path)

    def _record(self, spec: dict) -> None:
        row = dict(spec, written_at=datetime.now(timezone.utc))
        self.spark.createDataFrame([row], _META_SCHEMA).coalesce(1).write.mode("append").parquet(self.meta_path)
        self._specs[spec["name"]] = row

    def get_table(self, name: str, refresh: bool = False) -> dict:
        """Latest spec of a table (cached per instance; ``refresh`` re-reads the metadata)."""
        if not refresh and name in self._specs:
            return dict(self._specs[name])
        rows = (
            self._meta().where(F.col("name") == name).orderBy(F.col("version").desc()).limit(1).collect()
        )
        if not rows:
            raise KeyError(f"feature table {name!r} does not exist")
        self._specs[name] = rows[0].asDict()
        return dict(self._specs[name])

    def search(self, pattern: str = "%") -> DataFrame:
        """ML10: latest metadata of every table whose name matches a SQL LIKE pattern."""
        m = self._meta().where(F.col("name").like(pattern))
        latest = m.groupBy("name").agg(F.max("version").alias("version"))
        return m.join(latest, ["name", "version"]).select(
            "name", "description", "primary_keys", "partition_columns", "schema_json", "row_count", "version", "written_at"
        )

    # ---- tables ---------------------------------------------------------
    def create_table(
        self,
        name: str,
        primary_keys: list[str] | str,
        df: DataFrame,
        partition_columns: list[str] | str | None = None,
        description: str = "",
        partition_expr: dict[str, str] | None = None,
        buckets: int | None = None,
    ) -> dict:
        """SK9: write ``df`` as a new keyed table; duplicate keys are refused.

        ``partition_expr`` optionally records how each partition column is computed
        from the key columns (SQL text), which lets lookups read only the partitions
        their input can match (``lookup(..., prune_partitions=True)``).

        ``buckets`` keeps every partition in so many buckets by the keys, for tables that are looked up often:
        the table's side of a lookup is then not shuffled.  Take the session's shuffle partitions at least;
        Spark shuffles both sides where there are fewer buckets.
        """
        keys = [primary_keys] if isinstance(primary_keys, str) else list(primary_keys)
        parts = [partition_columns] if isinstance(partition_columns, str) else list(partition_columns or [])
        exists = self._meta().where(F.col("name") == name).limit(1).count() > 0
        if exists:
            raise ValueError(f"feature table {name!r} already exists")
        if buckets is not None and (buckets < 1 or set(keys) & set(parts)):
            raise ValueError("buckets: one at least, and keys that are no partition columns")
        path = f"{self.root}/tables/{name}-{uuid.uuid4().hex[:8]}"
        table = VersionedTable(self.spark, path, df.schema, parts, buckets=(buckets, keys) if buckets else None)
        rows = self._write_checked(table, df, keys, partition_expr, name)
        spec = {
            "name": name,
            "path": path,
            "primary_keys": keys,
            "partition_columns": parts,
            "description": description,
            "schema_json": df.schema.json(),
            "row_count": rows,
            "version": 1,
            "partition_expr_json": json.dumps(partition_expr) if partition_expr else None,
            "buckets": buckets,
        }
        self._record(spec)
        return spec

    def _write_checked(self, table: VersionedTable, df: DataFrame, keys: list[str], partition_expr: dict[str, str] | None, name: str) -> int:
        """Write and publish ``df`` as the whole table; its number of rows.  The exchange that groups by key
        counts duplicates on its way to the files, and nothing is published if there are any."""
        cols = table.schema.fieldNames()
        rest = [c for c in cols if c not in keys]
        grouping = table.grouping(keys)
        one = table.clustered(df).groupBy(*grouping).agg(F.first(F.struct(*rest)).alias("_rest"), F.count(F.lit(1)).alias("_n"))
        wrong = F.lit(0) if not partition_expr else F.when(~F.expr(" AND ".join(f"({e}) <=> `{c}`" for c, e in partition_expr.items())), 1).otherwise(0)
        flat = one.select(*grouping, *[F.col("_rest")[c].alias(c) for c in rest], "_n") if rest else one.select(*grouping, "_n")
        obs = Observation(f"create_{uuid.uuid4().hex[:8]}")
        flat = flat.observe(obs, F.count(F.lit(1)).alias("rows"), F.max("_n").alias("most"), F.max(wrong).alias("wrong"))
        written = table.write(flat)
        seen = obs.get
        error = None
        if (seen["most"] or 0) > 1:
            error = DuplicateKeyError(f"duplicate primary keys {keys} in the rows for {name!r}; table not registered")
        elif seen["wrong"]:
            error = ValueError(f"rows for {name!r} are not in the partition that {partition_expr} gives; table not registered")
        if error:
            table.discard(written)
            raise error
        table.publish(written)
        return int(seen["rows"])

    def write_table(self, name: str, df: DataFrame, mode: str = "merge") -> dict:
        """SK10: ``merge`` upserts by primary key; ``overwrite`` replaces the table's rows."""
        spec = self.get_table(name)
        keys, parts, path = list(spec["primary_keys"]), list(spec["partition_columns"]), spec["path"]
        # one staging slot per table, overwritten by each write: a stage is only read by
        # its own upsert, and one writer per table is the rule, so storage stays bounded
        table = self._table(spec)
        staging = f"{self.root}/_staging/{name}"
        df.select(*table.schema.fieldNames()).write.mode("overwrite").parquet(staging)
        batch = self.spark.read.schema(table.schema).parquet(staging)
        exprs = json.loads(spec["partition_expr_json"]) if spec.get("partition_expr_json") else None
        try:
            if mode == "merge":
                merge_versioned(table, batch, keys, exprs)
            elif mode == "overwrite":
                self._write_checked(table, batch, keys, exprs, name)
            else:
                raise ValueError("mode must be 'merge' or 'overwrite'")
        except DuplicateKeyError as e:
            raise DuplicateKeyError(f"{e} in the batch for {name!r}; table unchanged") from None
        # row count from parquet footers only (no data pages read)
        rows = table.read().count()
        new = dict(spec, path=path, row_count=int(rows), version=int(spec["version"]) + 1)
        new.pop("written_at", None)
        self._record(new)
        return new

    def _table(self, spec: dict) -> VersionedTable:
        schema = T.StructType.fromJson(json.loads(spec["schema_json"]))
        buckets = (spec["buckets"], list(spec["primary_keys"])) if spec.get("buckets") else None
        return VersionedTable(self.spark, spec["path"], schema, list(spec["partition_columns"]), buckets=buckets)

    def clone_table(self, name: str, new_name: str) -> dict:
        """SK13: a feature table with the rows of ``name`` and no copied file; both change on their own from here."""
        spec = self.get_table(name)
        if self._meta().where(F.col("name") == new_name).limit(1).count():
            raise ValueError(f"feature table {new_name!r} already exists")
        path = f"{self.root}/tables/{new_name}-{uuid.uuid4().hex[:8]}"
        self._table(spec).clone_to(path)
        new = dict(spec, name=new_name, path=path, version=1)
        new.pop("written_at", None)
        self._record(new)
        return new

    def read_table(self, name: str) -> DataFrame:
        return self._table(self.get_table(name)).read()

    def publish_views(self, schema: str | None = None) -> list[str]:
        """Feature tables by SQL name: a temporary view of each table (``name``, or ``schema_name``)."""
        names = [r["name"] for r in self.search().select("name").collect()]  # one row per table
        for n in names:
            self.read_table(n).createOrReplaceTempView(f"{schema}_{n}" if schema else n)
        return names

    # ---- lookups --------------------------------------------------------
    def _lookup_side(self, lookup: FeatureLookup, df: DataFrame | None = None) -> DataFrame:
        spec = self.get_table(lookup.table_name)
        keys = list(spec["primary_keys"])
        if len(keys) != len(lookup.lookup_key):
            raise ValueError(f"{lookup.table_name}: lookup_key has {len(lookup.lookup_key)} columns, table keys {keys}")
        stored = self._table(spec)
        table = stored.read_bucketed() if stored.buckets else stored.read().withColumn(ZERO, F.lit(0).cast("long"))
        exprs = json.loads(spec["partition_expr_json"]) if spec.get("partition_expr_json") else None
        if df is not None and exprs:
            # the partitions the input can match: the recorded expressions over the input's lookup keys, one row
            # a partition value, so it may be sent to every task.  Spark prunes the scan by it while it runs
            # (dynamic partition pruning, which wants a comparison on the pruning side)
            as_keys = df.select(*[F.col(lk).alias(k) for lk, k in zip(lookup.lookup_key, keys)])
            wanted = as_keys.select(*[F.expr(e).alias(f"__want{i}") for i, e in enumerate(exprs.values())])
            wanted = wanted.where(F.col("__want0").cast("string") >= "").distinct()
            cond = None
            for i, c in enumerate(exprs):
                same = table[c] == wanted[f"__want{i}"]
                cond = same if cond is None else cond & same
            table = table.join(F.broadcast(wanted), cond, "left_semi")
        return table.select(*[F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)], ZERO, *lookup.feature_names)

    def lookup(self, df: DataFrame, lookups: list[FeatureLookup], prune_partitions: bool = False) -> DataFrame:
        """JN3: one LEFT equi-join per lookup, chained; every input row is kept once.

        The table side is unique on its keys (checked at write), so no input row is
        duplicated.  Spark chooses the join from file and measured sizes.  Input rows with a
        NULL key cannot match; in a shuffle they would all meet in one task, so their key is
        replaced by a spread value beside the join and they keep NULL features.

        ``prune_partitions`` (for tables created with ``partition_expr``) derives the
        partitions the input's keys fall in -- one more pass over the input's key
        columns, in the same query -- and reads only those: the choice for scoring a
        recent slice against a long history; leave it off when the input spans the table.

        A bucketed table is not shuffled (the input's key columns need the table's types for that), so adaptive
        execution cannot split a hot key.  A sketch, one pass over the input's keys, finds keys of more than an
        even bucket's rows (256 at most).  Their rows are spread like those without a key and take their features
        from a broadcast of the table's rows of these keys, one each, which costs one more pass over the table
        where there are any.
        """
        out = df
        for lu in lookups:
            side = self._lookup_side(lu, df if prune_partitions else None)
            names = [f"__key{i}" for i in range(len(lu.lookup_key))]
            apart = out[lu.lookup_key[0]].isNull()
            for k in lu.lookup_key[1:]:
                apart = apart | out[k].isNull()
            buckets = self.get_table(lu.table_name).get("buckets")
            hot = self._hot_lookups(df, side, lu, buckets) if buckets else []
            if hot:
                apart = apart | F.coalesce(self._lookup_hash(side, lu).isin(hot), F.lit(False))
            # a last key part: 0 where the row may match, else spread over negative numbers (never a literal,
            # which would be folded out of the join and leave fewer columns than the buckets have)
            row = F.xxhash64(*[out[c] for c in out.columns])
            spread = F.when(apart, -1 - F.pmod(row, F.lit(1 << 20))).otherwise(row.bitwiseAND(F.lit(0)))
            base, out = out.columns, out.withColumn("__spread", spread)
            if hot:
                out = self._with_hot_features(out, base, side, lu, hot)
                continue
            cond = out["__spread"] == side[ZERO]
            for n, k in zip(names, lu.lookup_key):
                cond = cond & (out[k] == side[n])
            out = out.join(side, cond, "left").drop("__spread", ZERO, *names)
        return out

    def _lookup_hash(self, side: DataFrame, lu: FeatureLookup):
        """Hash of an input row's lookup key, in the types of the table's keys."""
        return key_hash(*[F.col(k).try_cast(side.schema[f"__key{i}"].dataType) for i, k in enumerate(lu.lookup_key)])

    def _hot_lookups(self, df: DataFrame, side: DataFrame, lu: FeatureLookup, buckets: int) -> list[int]:
        """Hashes of the keys that hold more of the input than an even bucket."""
        return list(hot_keys(df.dropna(subset=lu.lookup_key), self._lookup_hash(side, lu), buckets))

    def _with_hot_features(self, out: DataFrame, base: list[str], side: DataFrame, lu: FeatureLookup, hot: list[int]) -> DataFrame:
        """``base`` and the features: rows of hot keys (their ``__spread`` is negative) from a broadcast of the
        table's rows of these keys, all others from the buckets."""
        names = [f"__key{i}" for i in range(len(lu.lookup_key))]
        few = side.where(key_hash(*names).isin(hot)).drop(ZERO)
        few = few.toDF(*[f"__few{i}" for i in range(len(names))], *[f"__hot{i}" for i in range(len(lu.feature_names))])
        side = side.toDF(*names, ZERO, *[f"__feature{i}" for i in range(len(lu.feature_names))])
        stored, held = out["__spread"] == side[ZERO], out["__spread"] < 0
        for i, k in enumerate(lu.lookup_key):
            stored, held = stored & (out[k] == side[names[i]]), held & (out[k] == few[f"__few{i}"])
        joined = out.join(side, stored, "left").join(F.broadcast(few), held, "left")
        features = [F.when(F.col("__spread") < 0, F.col(f"__hot{i}")).otherwise(F.col(f"__feature{i}")).alias(f) for i, f in enumerate(lu.feature_names)]
        return joined.select(*[out[c] for c in base], *features)

    def create_training_set(
        self,
        df: DataFrame,
        feature_lookups: list[FeatureLookup],
        label: str | None,
        exclude_columns: list[str] | None = None,
        prune_partitions: bool = False,
    ) -> TrainingSet:
        """ML1: input columns + looked-up features; ``load_df()`` drops the excluded columns."""
        joined = self.lookup(df, feature_lookups, prune_partitions)
        return TrainingSet(joined, list(feature_lookups), label, list(exclude_columns or []))

