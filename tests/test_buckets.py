"""Feature tables in buckets: no shuffle of the stored side, the same rows in every case (JN3, SK9, SK10, SK13)."""

import pytest
from pyspark.sql import functions as F

from lakelet.session import new_run_dir
from lakelet.store.feature_store import DuplicateKeyError, FeatureLookup, FeatureStore

SCHEMA = "zip long, ts int, yyyy_mm string, v double"
MONTH = {"yyyy_mm": "concat('2024-0', CAST(1 + ts div 200 AS STRING))"}
BUCKETS = 8


@pytest.fixture
def no_broadcast(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def _features(spark, n=3000):
    at = (F.col("id") % 600).cast("int")
    return spark.range(n).select(F.col("id").alias("zip"), at.alias("ts"), F.expr(MONTH["yyyy_mm"].replace("ts", "CAST(id % 600 AS INT)")).alias("yyyy_mm"), (F.col("id") * 0.5).alias("v"))


def _stores(spark, **kw):
    st = FeatureStore(spark, new_run_dir(spark, "test-buckets"))
    st.create_table("plain", ["zip", "ts"], _features(spark), "yyyy_mm", **kw)
    st.create_table("bucketed", ["zip", "ts"], _features(spark), "yyyy_mm", buckets=BUCKETS, **kw)
    return st


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _both(st, rows, **kw):
    return [st.lookup(rows, [FeatureLookup(t, ["v"], ["z", "t"])], **kw) for t in ("plain", "bucketed")]


def _plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out.splitlines()


def _above(plan, what):
    """Operators on the way from the plan's root to the line that holds ``what``."""
    at = next(i for i, ln in enumerate(plan) if what in ln)
    out = []
    col = min(plan[at].find(c) for c in ("+-", ":-") if c in plan[at])
    for ln in reversed(plan[:at]):
        here = [ln.find(c) for c in ("+-", ":-") if c in ln]
        if here and max(here) < col:
            col = max(here)
            out.append(ln.strip())
    return out


def test_stored_side_is_pruned_and_not_shuffled(spark, capsys, no_broadcast):
    st = _stores(spark, partition_expr=MONTH)
    rows = spark.range(50, 150).select((F.col("id") * 2).alias("z"), (F.col("id") * 2).cast("int").alias("t"), "id")
    plain, bucketed = _both(st, rows, prune_partitions=True)
    want = [(i * 2, i * 2, i, float(i)) for i in range(50, 150)]
    assert _rows(plain) == _rows(bucketed) == sorted(want, key=str)
    plan = _plan(bucketed, capsys)
    scan = next(ln for ln in plan if "FileScan parquet" in ln and "lakelet_v_" in ln)
    assert "Bucketed: true" in scan and "dynamicpruning" in scan
    above = _above(plan, "FileScan parquet")
    assert any("SortMergeJoin" in ln for ln in above)
    assert not any("Exchange hashpartitioning" in ln for ln in above)
    assert any("Exchange hashpartitioning" in ln for ln in _above(_plan(plain, capsys), "FileScan parquet"))


def test_hot_key_missing_keys_and_other_types(spark, no_broadcast):
    """A key of a third of the rows, keys that are null, and keys in no table, of a wider type than the table's."""
    st = _stores(spark)
    i = F.col("id")
    rows = spark.range(6000).select(F.when(i % 3 == 0, 7).when(i % 3 == 1, F.lit(None)).otherwise(i).cast("long").alias("z"),
                                    F.when(i % 3 == 0, 7).when(i % 7 == 0, F.lit(None)).when(i % 11 == 0, F.lit(1 << 40)).otherwise(i % 600).cast("long").alias("t"), "id")
    plain, bucketed = _both(st, rows)
    got = _rows(bucketed)
    assert got == _rows(plain) and len(got) == 6000
    assert sum(r[0] == 7 and r[3] == 3.5 for r in got) == 2000
    assert len(st._hot_lookups(rows, st._lookup_side(FeatureLookup("bucketed", ["v"], ["z", "t"])), FeatureLookup("bucketed", ["v"], ["z", "t"]), BUCKETS)) == 1
    same_types = rows.withColumn("t", F.expr("try_cast(t AS INT)"))
    plain, bucketed = _both(st, same_types)
    assert _rows(bucketed) == _rows(plain)
    joined = bucketed.withColumn("part", F.spark_partition_id()).groupBy("part").count().collect()
    assert max(r["count"] for r in joined) < 2000  # the hot key does not stand in one task


def test_clashing_names_and_two_lookups(spark, no_broadcast):
    st = _stores(spark)
    rows = spark.range(900).select(F.lit(7).cast("long").alias("z"), F.lit(7).alias("t"), "id")
    lookups = [FeatureLookup("bucketed", ["v"], ["z", "t"]), FeatureLookup("bucketed", ["yyyy_mm"], ["id", "t"])]
    out = st.lookup(rows, lookups)
    assert out.columns == ["z", "t", "id", "v", "yyyy_mm"]
    assert _rows(out) == sorted([(7, 7, k, 3.5, "2024-01" if k in (7, 607) else None) for k in range(900)], key=str)


def test_merge_clone_and_null_partition_keep_buckets(spark, capsys, no_broadcast):
    st = _stores(spark)
    new = spark.createDataFrame([(1, 1, "2024-01", -1.0), (9999, 5, None, -2.0), (None, 3, "2024-03", -3.0)], SCHEMA)
    st.clone_table("bucketed", "copy")
    for t in ("plain", "bucketed"):
        st.write_table(t, new)
    assert _rows(st.read_table("plain")) == _rows(st.read_table("bucketed"))
    assert st.read_table("bucketed").columns == st.read_table("plain").columns
    rows = spark.createDataFrame([(1, 1), (9999, 5), (2, 2), (None, 3)], "z long, t int")
    plain, bucketed = _both(st, rows)
    assert _rows(plain) == _rows(bucketed) == sorted([(1, 1, -1.0), (9999, 5, -2.0), (2, 2, 1.0), (None, 3, None)], key=str)
    copied = st.lookup(rows, [FeatureLookup("copy", ["v"], ["z", "t"])])
    assert _rows(copied) == sorted([(1, 1, 0.5), (9999, 5, None), (2, 2, 1.0), (None, 3, None)], key=str)
    plan = _plan(copied, capsys)
    assert any("Bucketed: true" in ln for ln in plan)
    with pytest.raises(DuplicateKeyError):
        st.write_table("bucketed", new.unionByName(new))
    assert _rows(st.read_table("plain")) == _rows(st.read_table("bucketed"))
    st.write_table("bucketed", new, mode="overwrite")
    assert _rows(_both(st, rows)[1]) == sorted([(1, 1, -1.0), (9999, 5, -2.0), (2, 2, None), (None, 3, None)], key=str)


def test_unpartitioned_empty_and_old_names(spark):
    st = FeatureStore(spark, new_run_dir(spark, "test-buckets"))
    st.create_table("one", "zip", _features(spark, 40).select("zip", "v"), buckets=BUCKETS)
    st.create_table("none", "zip", _features(spark, 0).select("zip", "v"), buckets=BUCKETS)
    rows = spark.createDataFrame([(3,), (None,), (77,)], "z long")
    assert _rows(st.lookup(rows, [FeatureLookup("one", ["v"], ["z"])])) == sorted([(3, 1.5), (None, None), (77, None)], key=str)
    assert _rows(st.lookup(rows, [FeatureLookup("none", ["v"], ["z"])])) == sorted([(3, None), (None, None), (77, None)], key=str)
    before = {r.tableName for r in spark.sql("SHOW TABLES LIKE 'lakelet_v_*'").collect()}
    for k in range(8):
        st.write_table("one", spark.createDataFrame([(3, float(k))], "zip long, v double"))
        assert _rows(st.lookup(rows, [FeatureLookup("one", ["v"], ["z"])]))[0] == (3, float(k))
    after = {r.tableName for r in spark.sql("SHOW TABLES LIKE 'lakelet_v_*'").collect()}
    assert len(after) <= len(before) + 5  # names go with the versions that are no longer kept
    assert not spark.sql("SHOW TABLES LIKE 'lakelet_load_*'").collect()
    with pytest.raises(ValueError):
        st.create_table("bad", ["zip", "yyyy_mm"], _features(spark, 3), "yyyy_mm", buckets=BUCKETS)


def test_grouping_by_key_is_the_exchange_that_places_buckets(spark, capsys):
    from lakelet.store.versions import VersionedTable

    rows = _features(spark, 100)
    table = VersionedTable(spark, new_run_dir(spark, "test-buckets"), rows.schema, ["yyyy_mm"], buckets=(BUCKETS, ["zip", "ts"]))
    both = rows.withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)))
    merged = table.clustered(both).groupBy(*table.grouping(["zip", "ts"])).agg(F.max_by("v", "_new").alias("v"), F.sum("_new").alias("n"))
    assert sum("Exchange" in ln for ln in _plan(merged, capsys)) == 1
    assert merged.where("n = 1").count() == 100
