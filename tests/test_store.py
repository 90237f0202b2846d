"""Feature tables: upsert laws, key rules, lookups, discovery."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from lakelet.session import new_run_dir
from lakelet.store.feature_store import DuplicateKeyError, FeatureLookup, FeatureStore

SCHEMA = "zip long, ts int, yyyy_mm string, v double"


def _store(spark):
    return FeatureStore(spark, new_run_dir(spark, "test-store"))


def _files(path):
    out = {}
    for root, _, files in os.walk(path.removeprefix("file:")):
        for f in files:
            if f.endswith(".parquet"):
                p = os.path.join(root, f)
                out[p] = os.path.getmtime(p)
    return out


def test_upsert_laws(spark):
    st = _store(spark)
    base = spark.createDataFrame(
        [(1, 100, "2024-01", 1.0), (2, 100, "2024-01", 2.0), (1, 200, "2024-02", 3.0), (None, 300, "2024-02", 4.0)], SCHEMA
    )
    spec = st.create_table("t", ["zip", "ts"], base, "yyyy_mm", "test table")
    jan_before = {p: m for p, m in _files(spec["path"]).items() if "yyyy_mm=2024-01" in p}
    batch = spark.createDataFrame([(1, 200, "2024-02", 30.0), (5, 200, "2024-02", 5.0), (None, 300, "2024-02", 40.0)], SCHEMA)
    st.write_table("t", batch, mode="merge")
    got = sorted(((r.zip, r.ts, r.v) for r in st.read_table("t").collect()), key=str)
    # existing key replaced, new key added, untouched key kept, NULL key compared null-safe
    assert got == sorted([(1, 100, 1.0), (2, 100, 2.0), (1, 200, 30.0), (5, 200, 5.0), (None, 300, 40.0)], key=str)
    # the untouched partition keeps its files
    jan_after = {p: m for p, m in _files(st.get_table("t")["path"]).items() if "yyyy_mm=2024-01" in p}
    assert jan_after == jan_before
    # idempotent: the same batch again changes nothing
    st.write_table("t", batch, mode="merge")
    again = sorted(((r.zip, r.ts, r.v) for r in st.read_table("t").collect()), key=str)
    assert again == got
    assert st.get_table("t")["row_count"] == 5


def test_duplicate_keys_refused(spark):
    st = _store(spark)
    dup = spark.createDataFrame([(1, 100, "2024-01", 1.0), (1, 100, "2024-01", 2.0)], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        st.create_table("d", ["zip", "ts"], dup, "yyyy_mm")
    ok = spark.createDataFrame([(1, 100, "2024-01", 1.0)], SCHEMA)
    st.create_table("d2", ["zip", "ts"], ok, "yyyy_mm")
    with pytest.raises(DuplicateKeyError):
        st.write_table("d2", dup, mode="merge")
    assert [r.v for r in st.read_table("d2").collect()] == [1.0]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_lookup_keeps_every_row_and_misses_are_null(spark, threshold):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        _lookup_case(spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def _lookup_case(spark):
    st = _store(spark)
    feats = spark.createDataFrame([(1, 100, "2024-01", 7.0), (2, 100, "2024-01", 8.0)], SCHEMA)
    st.create_table("f", ["zip", "ts"], feats, "yyyy_mm")
    rows = spark.createDataFrame([(1, 100, 0.5), (1, 100, 0.6), (3, 100, 0.7), (None, 100, 0.8)], "z long, t int, x double")
    ts = st.create_training_set(rows, [FeatureLookup("f", ["v"], ["z", "t"])], label="x", exclude_columns=["t"])
    out = ts.load_df()
    assert out.columns == ["z", "x", "v"]
    got = sorted(((r.z, r.x, r.v) for r in out.collect()), key=str)
    assert got == sorted([(1, 0.5, 7.0), (1, 0.6, 7.0), (3, 0.7, None), (None, 0.8, None)], key=str)


def test_search_and_overwrite(spark):
    st = _store(spark)
    df = spark.createDataFrame([(1, 100, "2024-01", 1.0)], SCHEMA)
    name = f"trip_pickup_{uuid.uuid4().hex[:6]}"
    st.create_table(name, ["zip", "ts"], df, "yyyy_mm", "Pickup features")
    found = st.search("trip_pickup%").collect()
    assert [r.name for r in found] == [name] and found[0].description == "Pickup features"
    st.write_table(name, spark.createDataFrame([(9, 9, "2024-03", 9.0)], SCHEMA), mode="overwrite")
    assert [(r.zip, r.v) for r in st.read_table(name).collect()] == [(9, 9.0)]
    assert st.search(name).first().version == 2
    with pytest.raises(ValueError):
        st.create_table(name, ["zip", "ts"], df, "yyyy_mm")
    assert st.read_table(name).where(F.col("zip") == 9).count() == 1


def test_moved_key_leaves_no_second_row(spark):
    """Without a recorded expression a key may come back in another partition: the old row goes."""
    st = _store(spark)
    st.create_table("m", ["zip", "ts"], spark.createDataFrame([(1, 100, "2024-01", 1.0), (2, 100, "2024-01", 2.0), (7, 7, "2023-12", 7.0)], SCHEMA), "yyyy_mm")
    st.write_table("m", spark.createDataFrame([(1, 100, "2024-02", 10.0), (7, 7, "2024-02", 70.0)], SCHEMA), mode="merge")
    got = sorted((r.zip, r.yyyy_mm, r.v) for r in st.read_table("m").collect())
    assert got == [(1, "2024-02", 10.0), (2, "2024-01", 2.0), (7, "2024-02", 70.0)]


def test_partition_rule_is_verified(spark):
    st = _store(spark)
    month = {"yyyy_mm": "CASE WHEN ts < 200 THEN '2024-01' ELSE '2024-02' END"}
    good = spark.createDataFrame([(1, 100, "2024-01", 1.0)], SCHEMA)
    bad = spark.createDataFrame([(1, 100, "2024-02", 2.0)], SCHEMA)
    st.create_table("e", ["zip", "ts"], good, "yyyy_mm", partition_expr=month)
    with pytest.raises(ValueError):
        st.write_table("e", bad, mode="merge")
    with pytest.raises(ValueError):
        st.create_table("e2", ["zip", "ts"], bad, "yyyy_mm", partition_expr=month)
    assert [tuple(r) for r in st.read_table("e").collect()] == [(1, 100, "2024-01", 1.0)]


def test_write_broken_before_publishing_changes_nothing(spark, monkeypatch):
    from lakelet.store.versions import VersionedTable

    st = _store(spark)
    st.create_table("b", ["zip", "ts"], spark.createDataFrame([(1, 100, "2024-01", 1.0), (2, 100, "2024-01", 2.0)], SCHEMA), "yyyy_mm")
    batch = spark.createDataFrame([(1, 100, "2024-01", 10.0)], SCHEMA)

    def die(self, entries, base=None):
        raise OSError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "publish", die)
        with pytest.raises(OSError):
            st.write_table("b", batch, mode="merge")
    assert sorted(r.v for r in st.read_table("b").collect()) == [1.0, 2.0]
    st.write_table("b", batch, mode="merge")
    assert sorted(r.v for r in st.read_table("b").collect()) == [2.0, 10.0]


def test_views_and_no_empty_files(spark):
    st = _store(spark)
    st.create_table("by_name", ["zip", "ts"], spark.createDataFrame([(1, 100, "2024-01", 1.0)], SCHEMA), "yyyy_mm")
    n = len(_files(st.meta_path))
    FeatureStore(spark, st.root)
    assert len(_files(st.meta_path)) == n
    assert st.publish_views("feats") == ["by_name"]
    assert spark.sql("SELECT v FROM feats_by_name WHERE zip = 1").first().v == 1.0


def test_shared_folder_is_required_off_local_masters():
    from types import SimpleNamespace

    from lakelet.session import shared_dir

    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(fake)


def test_upsert_into_null_partition_keeps_other_rows(spark):
    st = _store(spark)
    base = spark.createDataFrame([(1, 1, None, 1.0), (2, 2, None, 2.0), (3, 3, "2024-01", 3.0)], SCHEMA)
    st.create_table("n", ["zip", "ts"], base, "yyyy_mm")
    st.write_table("n", spark.createDataFrame([(1, 1, None, 10.0), (4, 4, None, 4.0)], SCHEMA), mode="merge")
    got = sorted((r.zip, r.v) for r in st.read_table("n").collect())
    assert got == [(1, 10.0), (2, 2.0), (3, 3.0), (4, 4.0)]


def test_lookup_prunes_to_the_input_months(spark, capsys):
    st = _store(spark)
    month = {"yyyy_mm": "concat('2024-0', CAST(1 + ts div 200 AS STRING))"}
    feats = spark.createDataFrame([(1, 100, "2024-01", 7.0), (1, 200, "2024-02", 8.0), (2, 250, "2024-02", 9.0)], SCHEMA)
    st.create_table("pf", ["zip", "ts"], feats, "yyyy_mm", partition_expr=month)
    rows = spark.createDataFrame([(1, 100, 0.5), (3, 150, 0.7)], "z long, t int, x double")
    lu = [FeatureLookup("pf", ["v"], ["z", "t"])]
    pruned = st.lookup(rows, lu, prune_partitions=True)
    full = st.lookup(rows, lu)
    assert sorted(map(tuple, pruned.collect()), key=str) == sorted(map(tuple, full.collect()), key=str)
    assert sorted(map(tuple, pruned.collect()), key=str) == [(1, 100, 0.5, 7.0), (3, 150, 0.7, None)]
    capsys.readouterr()
    pruned.explain()
    plan = capsys.readouterr().out
    assert "dynamicpruning" in plan and "SubqueryBroadcast" in plan
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "yyyy_mm" in ln]
    assert scan and all("dynamicpruning" in ln for ln in scan)


def _folders(path):
    root = path.removeprefix("file:")
    return [d for d in os.listdir(f"{root}/data") if not d.startswith(".")], [f for f in os.listdir(f"{root}/log") if not f.startswith(".")]


def test_many_merges_leave_few_folders_and_two_files_a_read(spark, monkeypatch):
    """Each merge touches one of three months; dead folders go, a read opens the version and its checkpoint."""
    from lakelet.store import versions

    st = _store(spark)
    months = ["2024-01", "2024-02", "2024-03"]
    spec = st.create_table("m", ["zip", "ts"], spark.createDataFrame([(k, 0, m, 0.0) for k, m in enumerate(months)], SCHEMA), "yyyy_mm")
    table = versions.VersionedTable(spark, spec["path"], None, ["yyyy_mm"])
    for k in range(100):
        entries = table.entries()
        new = table.write(spark.createDataFrame([(k % 3, 0, months[k % 3], float(k))], SCHEMA).coalesce(1))
        table.publish({**entries, **new})
    data, log = _folders(spec["path"])
    assert len(data) <= len(months) + versions.KEEP_VERSIONS and len(log) <= versions.KEEP_VERSIONS + 3
    opened = []
    real = versions._get
    monkeypatch.setattr(versions, "_get", lambda spark, path: opened.append(path) or real(spark, path))
    assert sorted(r.v for r in table.read().collect()) == [97.0, 98.0, 99.0]
    assert len(opened) <= 2
    assert len(table.read().inputFiles()) == 3
    old = table.snapshot(table.versions()[0])
    assert table.read(old).count() == 3  # kept versions stay readable


def test_a_second_writer_is_refused(spark):
    from lakelet.store.feature_store import merge_versioned
    from lakelet.store.versions import ConcurrentWriteError, VersionedTable

    st = _store(spark)
    spec = st.create_table("w", ["zip", "ts"], spark.createDataFrame([(1, 1, "2024-01", 1.0)], SCHEMA), "yyyy_mm")
    first, second = (VersionedTable(spark, spec["path"], None, ["yyyy_mm"]) for _ in range(2))
    base = second.snapshot()
    merge_versioned(first, spark.createDataFrame([(2, 2, "2024-01", 2.0)], SCHEMA), ["zip", "ts"])
    with pytest.raises(ConcurrentWriteError):
        second.publish(second.write(spark.createDataFrame([(3, 3, "2024-01", 3.0)], SCHEMA)), base)
    # both began from the same version, in the middle of a merge
    real = VersionedTable.write

    def write_and_lose(self, df):
        out = real(self, df)
        merge_versioned(first, spark.createDataFrame([(4, 4, "2024-01", 4.0)], SCHEMA), ["zip", "ts"])
        return out

    second.write = lambda df: write_and_lose(second, df)
    with pytest.raises(ConcurrentWriteError):
        merge_versioned(second, spark.createDataFrame([(5, 5, "2024-01", 5.0)], SCHEMA), ["zip", "ts"])
    assert sorted(r.v for r in st.read_table("w").collect()) == [1.0, 2.0, 4.0]


def test_a_version_whose_writer_died_does_not_count(spark):
    st = _store(spark)
    spec = st.create_table("x", ["zip", "ts"], spark.createDataFrame([(1, 1, "2024-01", 1.0)], SCHEMA), "yyyy_mm")
    root = spec["path"].removeprefix("file:")
    open(f"{root}/log/0000000002.json", "w").write('{"checkpoint": 1, "chan')
    assert [r.v for r in st.read_table("x").collect()] == [1.0]
    st.write_table("x", spark.createDataFrame([(1, 1, "2024-01", 9.0)], SCHEMA))
    assert [r.v for r in st.read_table("x").collect()] == [9.0]


def test_changes_between_versions(spark):
    from lakelet.store.versions import VersionedTable

    st = _store(spark)
    spec = st.create_table("c", ["zip", "ts"], spark.createDataFrame([(1, 1, "2024-01", 1.0), (2, 2, "2024-02", 2.0), (3, 3, "2024-02", None)], SCHEMA), "yyyy_mm")
    table = VersionedTable(spark, spec["path"], None, ["yyyy_mm"])
    v = table.snapshot().version
    st.write_table("c", spark.createDataFrame([(2, 2, "2024-02", 20.0), (4, 4, None, 4.0)], SCHEMA))
    got = sorted(((r.zip, r.v, r["_change"]) for r in table.changes(v).collect()), key=str)
    assert got == [(2, 2.0, "delete"), (2, 20.0, "insert"), (4, 4.0, "insert")]
    assert table.changes(0, v).count() == 3 and table.changes(v, v).count() == 0


def test_clone_shares_files_and_diverges(spark):
    from lakelet.store import versions

    st = _store(spark)
    spec = st.create_table("src", ["zip", "ts"], spark.createDataFrame([(1, 1, "2024-01", 1.0), (2, 2, "2024-02", 2.0)], SCHEMA), "yyyy_mm")
    new = st.clone_table("src", "twin")
    assert not _files(new["path"]) and sorted(st.read_table("twin").inputFiles()) == sorted(st.read_table("src").inputFiles())
    st.write_table("twin", spark.createDataFrame([(2, 2, "2024-02", 20.0)], SCHEMA))
    for k in range(versions.KEEP_VERSIONS + 2):  # the source moves on; the clone's folder stays
        st.write_table("src", spark.createDataFrame([(1, 1, "2024-01", 100.0 + k)], SCHEMA))
    assert sorted(r.v for r in st.read_table("twin").collect()) == [1.0, 20.0]
    assert sorted(r.v for r in st.read_table("src").collect()) == [2.0, 106.0]
    source = versions.VersionedTable(spark, spec["path"], None, ["yyyy_mm"])
    before = len(_folders(spec["path"])[0])
    st.write_table("twin", spark.createDataFrame([(1, 1, "2024-01", 10.0)], SCHEMA))
    source.unpin(new["path"])
    source.clean()
    assert len(_folders(spec["path"])[0]) <= before and st.read_table("src").count() == 2 == st.read_table("twin").count()
    with pytest.raises(ValueError, match="already exists"):
        st.clone_table("src", "twin")
