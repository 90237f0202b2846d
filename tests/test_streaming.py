"""Streaming = batch, restarts, rules, explode, stream-static timing."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lakelet.operators.filters import Rule, apply_rules
from lakelet.plans.sales import sales_pipeline
from lakelet.plans.vitals import vitals_pipeline
from lakelet.session import new_run_dir

EPOCH_DAY1 = datetime(2024, 1, 2, 10, 0, tzinfo=timezone.utc).timestamp()
EPOCH_DAY2 = datetime(2024, 1, 3, 10, 0, tzinfo=timezone.utc).timestamp()


def test_rules_drop_false_and_null(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    obs = Observation("r")
    out = apply_rules(df, [Rule("pos", "x > 0")])
    assert [r.x for r in out.collect()] == [1]
    m = df.observe(obs, F.count(F.lit(1)).alias("n")).where("x > 0")
    m.collect()
    assert obs.get["n"] == 3


def test_explode_skips_empty_and_null(spark):
    df = spark.createDataFrame(
        [(1, [(1.0, 2.0)]), (2, []), (3, None), (4, [(1.0, 1.0), (2.0, 2.0)])],
        "k int, a array<struct<price:double,qty:double>>",
    )
    got = df.select("k", F.explode("a").alias("e")).groupBy("k").count().orderBy("k").collect()
    assert [(r.k, r[1]) for r in got] == [(1, 1), (4, 2)]


def _land_json(spark, rows, path):
    spark.createDataFrame(rows, "device_id string, mrn string, heartrate string, time double").coalesce(1).write.mode(
        "append"
    ).json(path)


def _land_patients(spark, rows, path):
    spark.createDataFrame(rows, "mrn int, name string").coalesce(1).write.mode("append").option("header", "true").csv(path)


def _daily(p):
    return sorted((r.mrn, r.name, r.avg_heartrate, str(r.date)) for r in p.read("daily_patient_avg").collect())


def test_vitals_stream_restarts_equal_batch(spark):
    run = new_run_dir(spark, "test-vitals")
    rec, pat = f"{run}/rec", f"{run}/pat"
    _land_patients(spark, [(1, "Ann"), (2, "Bo")], pat)
    _land_json(spark, [("1", "1", "80.5", EPOCH_DAY1), ("2", "2", "-5", EPOCH_DAY1), ("3", "3", "70", EPOCH_DAY1)], rec)

    def pipe():
        return vitals_pipeline(spark, rec, pat, f"{run}/storage", max_files_per_trigger=1)

    pipe().run()
    assert _daily(pipe()) == [(1, "Ann", 80.5, "2024-01-02")]

    # a second file for the same day, and the missing patient arrives later: the
    # stream-stream join keeps the early recording in state and now matches it
    _land_json(spark, [("1", "1", "90.5", EPOCH_DAY1 + 60), ("1", "1", "60", EPOCH_DAY2)], rec)
    _land_patients(spark, [(3, "Cy")], pat)
    p = pipe()
    p.run()
    first = _daily(p)
    assert first == [(1, "Ann", 60.0, "2024-01-03"), (1, "Ann", 85.5, "2024-01-02"), (3, "Cy", 70.0, "2024-01-02")]

    # restart without new files: nothing changes
    p2 = pipe()
    p2.run()
    assert _daily(p2) == first

    # equals the batch query over all landed files
    r = spark.read.json(rec).selectExpr("CAST(mrn AS BIGINT) mrn", "CAST(heartrate AS DOUBLE) hr", "CAST(time AS BIGINT) t")
    pt = spark.read.option("header", "true").option("inferSchema", "true").csv(pat)
    batch = (
        r.join(pt, "mrn").where("hr > 0")
        .groupBy("mrn", "name", F.to_date(F.timestamp_seconds("t")).alias("date"))
        .agg(F.round(F.avg("hr"), 6).alias("a"))
    )
    assert sorted((x.mrn, x.name, x.a, str(x.date)) for x in batch.collect()) == first

    # provenance columns on the bronze table, dataset descriptions recorded
    bronze = p2.read("recordings_bronze")
    assert bronze.columns[:2] == ["receipt_time", "source_file"]
    assert bronze.where(F.col("source_file").endswith(".json")).count() == bronze.count() == 5
    desc = {r.name: r for r in p2.describe().collect()}
    assert desc["daily_patient_avg"].comment == "Mean heart rate of each patient and UTC day"
    assert "heartrate > 0" in desc["recordings_enriched"].rules

    # the run log holds the rule counts: 5 enriched rows seen, 1 dropped by the rule
    ev = p2.events().where(F.col("dataset") == "recordings_enriched")
    tot = ev.agg(F.sum("rows_seen").alias("s"), F.sum("rows_dropped").alias("d")).first()
    assert (tot.s, tot.d) == (5, 1)


@pytest.mark.parametrize("broadcast", [True, False])
def test_sales_left_join_not_retroactive(spark, broadcast):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if not broadcast:  # force the salted shuffle join
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _sales_left_join_not_retroactive(spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def _sales_left_join_not_retroactive(spark):
    run = new_run_dir(spark, "test-sales")
    src = f"{run}/src"
    cust_schema = (
        "customer_id string, customer_name string, state string, city string, lon string, lat string, "
        "units_purchased string, loyalty_segment string"
    )
    order_schema = (
        "customer_id long, customer_name string, number_of_line_items long, order_datetime string, "
        "order_number long, ordered_products array<struct<curr:string,id:long,price:double,qty:double>>"
    )
    spark.createDataFrame([("1", "A", "S", "NATION_1", None, None, None, "X")], cust_schema).coalesce(1).write.option("header", "true").csv(
        f"{src}/customers"
    )
    spark.createDataFrame(
        [
            (1, "A", 1, "1704189600", 11, [("A", 5, 10.0, 2.0)]),
            (7, "G", 1, "1704189600", 12, [("A", 5, 1.0, 1.0)]),
            (1, "A", 0, "1704189600", None, [("A", 5, 99.0, 1.0)]),
        ],
        order_schema,
    ).coalesce(1).write.json(f"{src}/sales_orders")

    def pipe():
        return sales_pipeline(spark, src, f"{run}/storage")

    pipe().run()
    spark.createDataFrame([("7", "G", "S", "NATION_7", None, None, None, "Y")], cust_schema).coalesce(1).write.mode("append").option(
        "header", "true"
    ).csv(f"{src}/customers")
    spark.createDataFrame([(7, "G", 1, "1704276000", 13, [("R", 6, 3.0, 1.0)])], order_schema).coalesce(
        1
    ).write.mode("append").json(f"{src}/sales_orders")
    p = pipe()
    p.run()
    cleaned = {r.order_number: r.city for r in p.read("sales_orders_cleaned").collect()}
    assert cleaned == {11: "NATION_1", 12: None, 13: "NATION_7"}  # NULL order number dropped by the rule
    by_city = sorted((r.city, r.curr, r.sales, r.quantity, r.product_count) for r in p.read("sales_by_city").collect())
    assert by_city == [("NATION_1", "A", 10.0, 2.0, 1), ("NATION_7", "R", 3.0, 1.0, 1)]


@pytest.mark.parametrize("hot", [True, False])
def test_hot_key_is_spread_and_joined_once(spark, hot):
    """One patient with a third of all recordings, or none: every recording joins exactly once; the hot
    patient alone is copied, and its recordings land in every salt instead of one join partition."""
    from lakelet.operators.joins import SALT, hot_keys, key_hash, replicated, with_salt

    run = new_run_dir(spark, "test-hot")
    rec, pat = f"{run}/rec", f"{run}/pat"
    rows = [(str(i), "1" if hot and i % 3 == 0 else str(2 + i % 50), "70", EPOCH_DAY1 + i) for i in range(3000)]
    _land_json(spark, rows, rec)
    _land_patients(spark, [(m, f"p{m}") for m in range(1, 52)], pat)
    p = vitals_pipeline(spark, rec, pat, f"{run}/storage", state_partitions=8)
    p.run()
    enriched = p.read("recordings_enriched")
    assert enriched.count() == 3000
    assert enriched.where("mrn = 1").count() == (1000 if hot else 0)

    key = key_hash(F.col("mrn").cast("long"))
    found = hot_keys(spark.read.json(rec), key, 8)
    patients = spark.createDataFrame([(m,) for m in range(1, 52)], "mrn long")
    assert replicated(patients, key, found).count() == 51 + sum(n - 1 for n in found.values())
    assert p.fixed("recordings_enriched_hot", dict) == found
    if not hot:
        assert found == {}
        return
    assert list(found.values()) == [3]  # a third of the rows fills three of eight partitions
    salted = with_salt(spark.read.json(rec), key, found, "device_id", "mrn", "time")
    sizes = [r["count"] for r in salted.where("mrn = '1'").groupBy(SALT).count().collect()]
    assert len(sizes) == 3 and max(sizes) < 400
    assert salted.where(f"mrn <> '1' AND {SALT} <> 0").count() == 0


def test_hot_customers_of_each_run_are_spread(spark):
    """JN1, ST5: a customer with most of the orders is copied, and no order is lost or doubled."""
    from lakelet.plans import sales

    run = new_run_dir(spark, "test-hot-sales")
    src = f"{run}/src"
    names = "customer_id string, customer_name string, state string, city string, lon string, lat string, units_purchased string, loyalty_segment string"
    spark.createDataFrame([(str(k), f"C{k}", "S", "NATION_1", None, None, None, "X") for k in range(50)], names).write.option("header", "true").csv(f"{src}/customers")
    schema = "customer_id long, customer_name string, number_of_line_items long, order_datetime string, order_number long, ordered_products array<struct<curr:string,id:long,price:double,qty:double>>"
    for batch in range(2):
        rows = [(7 if k % 2 else k % 60, f"C{7 if k % 2 else k % 60}", 1, "1704189600", 1000 * batch + k, [("A", 5, 1.0, 1.0)]) for k in range(600)]
        spark.createDataFrame(rows, schema).write.mode("append").json(f"{src}/sales_orders")
        p = sales_pipeline(spark, src, f"{run}/storage", state_partitions=8)
        p.run()
        if not batch:
            assert p.fresh("sales_orders_raw", "nobody").count() == 600
    got = p.read("sales_orders_cleaned")
    assert got.count() == 1200 and got.select("order_number").distinct().count() == 1200
    assert got.where("city IS NULL").count() == got.where("customer_id >= 50").count() > 0
    hot = sales.hot_keys(p.read("sales_orders_raw"), sales.key_hash(F.col("customer_id"), F.col("customer_name")), 8)
    assert list(hot.values()) == [4]


def test_bounded_join_lets_state_go(spark):
    """ST4: pairs across batches; what can meet nobody any more leaves the state."""
    from lakelet.plans.funnel import EVENT_SCHEMA, funnel_pipeline

    run = new_run_dir(spark, "test-funnel")
    day = 86_400

    def at(s):
        return datetime.fromtimestamp(EPOCH_DAY1 + s, timezone.utc)

    clicks = [[(1, 1, at(0), 0.0), (2, 2, at(100), 0.0)], [(3, 1, at(day), 0.0)], [(4, 9, at(2 * day), 0.0)]]
    buys = [[(11, 1, at(6 * 3600), 5.0), (12, 2, at(50), 6.0)], [(13, 1, at(day), 7.0), (14, 1, at(day + 6 * 3600 + 1), 8.0)], [(15, 9, at(2 * day + 60), 9.0)]]
    p = funnel_pipeline(spark, f"{run}/src", f"{run}/storage", state_partitions=2)
    for c, b in zip(clicks, buys):
        for kind, rows in (("clicks", c), ("purchases", b)):
            spark.createDataFrame(rows, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{run}/src/{kind}")
        p.run()
    assert sorted((r.click_id, r.purchase_id) for r in p.read("click_purchases").collect()) == [(1, 11), (3, 13), (4, 15)]
    log = p.events().where("dataset = 'click_purchases'")
    assert log.agg(F.sum("state_rows_removed")).first()[0] >= 6  # both first days are gone
    assert log.orderBy(F.col("batch_id").desc()).first().state_rows <= 3


def test_bounded_left_join_tells_unmatched_rows(spark):
    from lakelet.plans.funnel import EVENT_SCHEMA, funnel_pipeline

    run = new_run_dir(spark, "test-funnel-left")
    p = funnel_pipeline(spark, f"{run}/src", f"{run}/storage", state_partitions=2, how="left")
    for day in range(3):
        t = datetime.fromtimestamp(EPOCH_DAY1 + day * 86_400, timezone.utc)
        for kind, user in (("clicks", day), ("purchases", 1)):
            spark.createDataFrame([(day, user, t, 1.0)], EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{run}/src/{kind}")
        p.run()
    # the click of day 0 met nobody and its time is over; that of day 2 may still meet somebody
    assert sorted((r.click_id, r.purchase_id) for r in p.read("click_purchases").collect()) == [(0, None), (1, 1)]


def test_interval_join_in_batch_and_clashing_names(spark):
    from lakelet.operators.joins import interval_join

    a = spark.createDataFrame([(1, EPOCH_DAY1), (2, EPOCH_DAY1), (None, EPOCH_DAY1)], "k int, s double").select("k", F.timestamp_seconds("s").alias("t"))
    b = a.select(F.col("k").alias("k2"), (F.col("t") - F.expr("INTERVAL 1 HOUR")).alias("t2"))
    assert interval_join(a, b, [("k", "k2")], "t", "t2", "-1 HOUR", "0 HOURS").count() == 2
    assert interval_join(a, b, [("k", "k2")], "t", "t2", "0 HOURS", "1 HOUR", how="left").where("k2 IS NULL").count() == 3
    with pytest.raises(ValueError, match="both sides"):
        interval_join(a, a, [("k", "k")], "t", "t", "0 HOURS", "1 HOUR")


def test_stream_over_a_rewritten_table(spark):
    """SC14: a change feed gives each row that came or went once; without one the stream is refused."""
    from lakelet.streaming.pipeline import Dataset, Pipeline

    run = new_run_dir(spark, "test-feed")
    rows = [("A", 1), ("A", 1), ("B", 2), ("C", None)]

    def pipe(feed):
        return Pipeline(spark, "t", f"{run}/s", [
            Dataset("t", lambda p: spark.createDataFrame(rows, "city string, n int"), kind="table", partition_by=["city"], feed=feed),
            Dataset("copy", lambda p: p.stream("t"))])

    with pytest.raises(ValueError, match="feed=True"):
        pipe(False).run()
    run = new_run_dir(spark, "test-feed")
    p = pipe(True)
    p.run()

    def seen():
        return sorted(((r.city, r.n, r["_change"]) for r in p.read("copy").collect()), key=str)

    first = [("A", 1, "insert"), ("A", 1, "insert"), ("B", 2, "insert"), ("C", None, "insert")]
    assert seen() == first
    p.run()
    assert seen() == first  # a refresh with the same rows changes nothing
    rows[:] = [("A", 1), ("B", 3), ("C", None), ("D", 4)]
    p.run()
    assert seen() == sorted([*first, ("A", 1, "delete"), ("B", 2, "delete"), ("B", 3, "insert"), ("D", 4, "insert")], key=str)


def test_feed_of_an_aggregate(spark):
    from lakelet.streaming.pipeline import Dataset, Pipeline

    run = new_run_dir(spark, "test-feed-agg")

    def pipe():
        raw = lambda p: spark.readStream.schema("k string, v long").json(f"{run}/src")
        total = lambda p: p.stream("raw").groupBy("k").agg(F.sum("v").alias("s"))
        return Pipeline(spark, "t", f"{run}/s", [Dataset("raw", raw), Dataset("sums", total, kind="aggregate", keys=["k"], feed=True),
                                                Dataset("moves", lambda p: p.stream("sums"))], state_partitions=2)

    for rows in ([("a", 1), ("b", 2)], [("a", 5)], []):
        if rows:
            spark.createDataFrame(rows, "k string, v long").coalesce(1).write.mode("append").json(f"{run}/src")
        p = pipe()
        p.run()
    got = sorted((r.k, r.s, r["_change"]) for r in p.read("moves").collect())
    assert got == [("a", 1, "delete"), ("a", 1, "insert"), ("a", 6, "insert"), ("b", 2, "insert")]


def test_batches_committed_before_the_driver_was_lost_are_logged(spark, monkeypatch):
    """ST7: the report of a committed batch was never taken; the next run logs the batch from the checkpoint."""
    from lakelet.streaming.pipeline import Dataset, Pipeline

    run = new_run_dir(spark, "test-lost")
    rec = f"{run}/rec"
    _land_json(spark, [("1", "1", "80", EPOCH_DAY1)], rec)
    schema = spark.read.json(rec).schema

    def pipe():
        return Pipeline(spark, "t", f"{run}/s", [Dataset("raw", lambda p: spark.readStream.schema(schema).json(rec))])

    def lost(self, *args):
        raise SystemExit("driver lost")

    with monkeypatch.context() as m:
        m.setattr(Pipeline, "_log", lost)
        with pytest.raises(SystemExit):
            pipe().run()
    for q in spark.streams.active:
        q.awaitTermination()
    assert pipe().events().count() == 0 and pipe().read("raw").count() == 1
    _land_json(spark, [("2", "2", "70", EPOCH_DAY1)], rec)
    p = pipe()
    p.run()
    got = sorted((r.batch_id, r.num_input_rows, r.metrics_json) for r in p.events().collect())
    assert got == [(0, None, '{"recovered": true}'), (1, 1, None)]
    p.run()
    assert p.events().count() == 2


def test_failed_run_restores_conf_and_logs_completed_datasets(spark):
    from lakelet.streaming.pipeline import Dataset, Pipeline

    run = new_run_dir(spark, "test-fail")
    rec = f"{run}/rec"
    _land_json(spark, [("1", "1", "80", EPOCH_DAY1)], rec)
    schema = spark.read.json(rec).schema

    def boom(p):
        raise RuntimeError("bad dataset")

    p = Pipeline(
        spark,
        "t",
        f"{run}/storage",
        [Dataset("raw", lambda p: spark.readStream.schema(schema).json(rec)), Dataset("broken", boom)],
        state_partitions=3,
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError, match="bad dataset"):
        p.run()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert [(r.dataset, r.num_input_rows) for r in p.events().collect()] == [("raw", 1)]
    assert p.read("raw").count() == 1


def _fails_on_third(spark, run, rec):
    from lakelet.streaming.pipeline import Dataset, Pipeline

    schema = spark.read.json(rec).schema

    def strict(p):
        df = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(rec)
        return df.withColumn("rate", F.when(F.col("heartrate") == "bad", F.raise_error(F.lit("bad rate"))).otherwise(F.col("heartrate").cast("double")))

    return Pipeline(spark, "t", f"{run}/storage", [Dataset("raw", strict, rules=[Rule("positive", "rate > 0")])])


def test_batches_before_a_failing_one_are_logged(spark):
    import time

    run = new_run_dir(spark, "test-third")
    rec = f"{run}/rec"
    for rate in ("80", "-5", "bad"):
        _land_json(spark, [("1", "1", rate, EPOCH_DAY1)], rec)
        time.sleep(1.1)  # files are taken in the order of their times
    p = _fails_on_third(spark, run, rec)
    conf = {k: spark.conf.get(k, None) for k in ("spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.numRecentProgressUpdates")}
    with pytest.raises(Exception, match="bad rate"):
        p.run()
    assert {k: spark.conf.get(k, None) for k in conf} == conf
    got = sorted((r.batch_id, r.rows_seen, r.rows_dropped) for r in p.events().collect())
    assert got == [(0, 1, 0), (1, 1, 1)]


def test_full_refresh_drops_partitions_that_are_gone(spark):
    from lakelet.streaming.pipeline import Dataset, Pipeline

    run = new_run_dir(spark, "test-refresh")
    rows = [("A", 1), ("B", 2)]
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        p = Pipeline(spark, "t", f"{run}/s", [Dataset("t", lambda p: spark.createDataFrame(rows, "city string, n int"), kind="table", partition_by=["city"])])
        p.run()
        rows.pop()
        p.run()
        assert [tuple(r) for r in p.read("t").collect()] == [("A", 1)]
        assert p.publish_views("ref") == ["t"] and spark.sql("SELECT count(*) AS n FROM ref_t").first().n == 1
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_system_tables_get_no_empty_files(spark):
    import os

    run = new_run_dir(spark, "test-empty")

    def count():
        return sum(f.endswith(".parquet") for _, _, fs in os.walk(f"{run}/x/system".removeprefix("file:")) for f in fs)

    vitals_pipeline(spark, "r", "p", f"{run}/x")
    n = count()
    vitals_pipeline(spark, "r", "p", f"{run}/x")
    assert count() == n


def test_csv_with_another_header_stops_and_long_rows_are_kept(spark):
    from lakelet.sources.ingest import RESCUED, incremental_source, infer_schema
    from lakelet.streaming.pipeline import Dataset, Pipeline

    run = new_run_dir(spark, "test-csv")
    src = f"{run}/csv"
    spark.createDataFrame([("a,b",), ("1,2",), ("3,4,5",)], "v string").coalesce(1).write.text(src)
    schema = infer_schema(spark, "csv", src, header=True, infer_types=False)
    p = Pipeline(spark, "t", f"{run}/s", [Dataset("c", lambda p: incremental_source(spark, "csv", src, schema, header=True))])
    p.run()
    assert sorted((r.a, r.b, r[RESCUED]) for r in p.read("c").collect()) == [("1", "2", None), ("3", "4", "3,4,5")]
    spark.createDataFrame([("a,c",), ("1,2",)], "v string").coalesce(1).write.mode("append").text(src)
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        p.run()


def test_new_members_at_any_depth_are_kept(spark):
    """SC4: objects inside fields, arrays, arrays of arrays and maps; repeated members; other types than known."""
    import json

    from pyspark.sql import types as T

    from lakelet.sources.ingest import RESCUED, incremental_source
    from lakelet.streaming.pipeline import Dataset, Pipeline

    run = new_run_dir(spark, "test-nested")
    schema = T.StructType.fromDDL("id long, items array<struct<price:double,tag:struct<a:string>>>, box struct<x:int>, grid array<array<struct<k:int>>>, extra map<string,struct<m:int>>")
    lines = [
        {"id": 1, "items": [{"price": 1.5, "tag": {"a": "p"}}], "box": {"x": 1}, "grid": [[{"k": 1}]], "extra": {"u": {"m": 1}}},
        {"id": 2, "items": [{"price": 1.0}, {"price": 2.0, "color": "red", "tag": {"a": "q", "b": [1, 2]}}], "box": {"x": 1, "y": {"z": None}},
         "grid": [[], [{"k": 1}, {"k": 2, "l": 3}]], "extra": {"u": {"m": 1, "n": "w"}}, "new": True},
        {"id": 3, "items": None, "box": None, "grid": [], "extra": None},
        {"id": 4, "items": [], "box": {"x": "seven"}},
    ]
    text = [json.dumps(x) for x in lines] + ['{"id": 5, "new": 1, "new": 2}', '{"id": 6', "[1]", "   "]
    spark.createDataFrame([(t,) for t in text], "value string").coalesce(1).write.text(f"{run}/src")
    p = Pipeline(spark, "t", f"{run}/s", [Dataset("raw", lambda p: incremental_source(spark, "json", f"{run}/src", schema))])
    p.run()
    rows = p.read("raw").collect()
    assert len(rows) == 7
    got = {r.id: r for r in rows if r.id in (1, 2, 3, 5)}
    assert got[1][RESCUED] is None and got[3][RESCUED] is None and got[1]["items"][0].tag.a == "p"
    assert json.loads(got[2][RESCUED]) == {"items[1].color": "red", "items[1].tag.b": "[1,2]", "box.y": '{"z":null}', "grid[1][1].l": "3", "extra.u.n": "w", "new": "true"}
    assert json.loads(got[5][RESCUED]) == {"new": "2"}
    kept = {r[RESCUED] for r in rows}
    assert {text[3], '{"id": 6', "[1]"} <= kept  # wrong types and broken lines whole
    assert p.events().first().metrics_json == '{"rows_rescued": 5}'


def test_lines_of_known_members_are_not_searched(spark, monkeypatch):
    """SC4: a line whose colons are all accounted for by what was read from it has no other member to look for."""
    from pyspark.sql import types as T

    from lakelet.sources import ingest
    from lakelet.streaming.pipeline import Dataset, Pipeline

    def searched(text, kind, path):
        at = F.raise_error(F.concat(F.lit("searched: "), text)).cast("string")
        return F.array(F.struct(at.alias("path"), at.alias("value")))

    monkeypatch.setattr(ingest, "_unknown", searched)
    run = new_run_dir(spark, "test-known")
    text = ['{"id": 1, "name": "a: b", "items": [{"k": 1, "t": ["x:y"]}, {}], "extra": {"u": {"m": ":"}}}', '{"items": [], "name": {"a": 1}}', '{"id": "x", "new": 1}']
    spark.createDataFrame([(t,) for t in text], "value string").coalesce(1).write.text(f"{run}/src")
    schema = T.StructType.fromDDL("id long, name string, items array<struct<k:int,t:array<string>>>, extra map<string,struct<m:string>>")
    p = Pipeline(spark, "t", f"{run}/s", [Dataset("raw", lambda p: ingest.incremental_source(spark, "json", f"{run}/src", schema))])
    p.run()
    assert {(r.id, r.name, r[ingest.RESCUED]) for r in p.read("raw").collect()} == {(1, "a: b", None), (None, '{"a":1}', None), (None, None, text[2])}


def test_sparing_the_search_loses_no_member(spark):
    """SC4: random lines with new, double and null members, colons, quotes and escapes: as the search alone finds."""
    import json
    import random

    from pyspark.sql import types as T

    from lakelet.sources import ingest

    rnd = random.Random(5)
    texts = ["", ":", "a:b", 'q"::', "\\", "é:", "null"]
    names = ["id", "name", "items", "extra", "box", "new", "a:b", ""]

    def value(depth):
        kind = rnd.random()
        if depth and kind < 0.35:
            pairs = [(rnd.choice(["k", "t", "m", "u", "new", "k:"]), value(depth - 1)) for _ in range(rnd.randint(0, 3))]
            return "{" + ", ".join(f"{json.dumps(n)}: {v}" for n, v in pairs) + "}"
        if depth and kind < 0.6:
            return "[" + ",".join(value(depth - 1) for _ in range(rnd.randint(0, 3))) + "]"
        return rnd.choice(["1", "2.5", "null", "true", json.dumps(rnd.choice(texts), ensure_ascii=rnd.random() < 0.5)])

    good = ['"id": 1', '"name": "a:b"', '"items": [{"k": 1, "t": [":"]}]', '"extra": {"u": {"m": "x"}}', '"box": {"k": 2}', '"id": null', '"new": 1', '"new": "\\u003a"']
    lines = []
    for _ in range(3000):
        parts = [rnd.choice(good) if rnd.random() < 0.85 else f"{json.dumps(rnd.choice(names))}: {value(3)}" for _ in range(rnd.randint(0, 5))]
        line = "{" + ", ".join(parts) + "}" + rnd.choice([""] * 8 + ["}", ' {"x": 1}'])
        lines.append(line.replace('"', "'") if rnd.random() < 0.05 else line)
    schema = T.StructType.fromDDL("id long, name string, items array<struct<k:int,t:array<string>>>, extra map<string,struct<m:string>>, box struct<k:int,t:map<string,string>>")
    df = spark.createDataFrame([(t,) for t in lines], "value string").repartition(4)
    read = ingest._json_lines(df, schema, F.col("value").alias("line"))
    found = ingest._unknown(F.col("line"), schema, F.lit(""))
    rows = read.select("line", ingest.RESCUED, F.size(found).alias("n")).collect()
    assert len(rows) == 3000 and 500 < sum(r.n > 0 for r in rows) < 2500
    assert not [r.line for r in rows if (r[ingest.RESCUED] is not None) != (r.n > 0) and r[ingest.RESCUED] != r.line]
    assert not [r.line for r in rows if r.n > 0 and r[ingest.RESCUED] is None]
