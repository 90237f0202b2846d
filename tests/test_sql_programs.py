"""Ping SQL program, reports and alert; small sources."""

import uuid

from pyspark.sql import functions as F

from lakelet.plans import ping
from lakelet.session import new_run_dir
from lakelet.sources.tables import file_inventory, number_sequence, preview, read_path, read_path_sql, values_view


def test_ping_setup_load_reports(spark):
    schema = f"ping_test_{uuid.uuid4().hex[:6]}"
    current = spark.catalog.currentDatabase()
    try:
        ping.setup(spark, schema, new_run_dir(spark, "ping-test"))
        for _ in range(3):
            ping.load(spark)
        rows = spark.table("user_ping").collect()
        assert all(0 <= r.ping < 250 for r in rows)
        assert all(r.user_id in ping.USER_NAMES for r in rows)
        assert len(rows) <= 27
        counts = ping.user_counts(spark).collect()
        assert sum(r.total_records for r in counts) == len(rows)
        # ordered by count desc, then name
        assert [(-r.total_records, r.user_id) for r in counts] == sorted((-r.total_records, r.user_id) for r in counts)
        s = ping.summary(spark).collect()
        assert all(r.first_seen <= r.last_seen for r in s)
        assert ping.avg_ping(spark).count() >= len(counts)
        alert = ping.Alert("total_records", ">", 0)
        assert alert.triggered(ping.user_counts(spark)) == (len(rows) > 0)
        assert not ping.Alert("total_records", ">", 10**9).triggered(ping.user_counts(spark))
    finally:
        spark.sql("USE IDENTIFIER(:d)", args={"d": current})


def test_setup_is_repeatable_and_activity_share(spark):
    schema = f"ping_again_{uuid.uuid4().hex[:6]}"
    current = spark.catalog.currentDatabase()
    try:
        ping.setup(spark, schema, new_run_dir(spark, "ping-again"))
        ping.setup(spark, schema)
        assert sorted(r.user_id for r in spark.table("user_ids").collect()) == sorted(ping.USER_NAMES)
        active = spark.range(20000).where("is_active()").count()
        assert 14000 < active < 16000
    finally:
        spark.sql("USE IDENTIFIER(:d)", args={"d": current})


def test_alert_plan_has_no_sort(spark, sf_small):
    plan = ping.q_alert_rows(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan.replace("SortAggregate", "")


def test_small_sources(spark, sf_small):
    v = values_view(spark, "colours_v", ["colour", "weight"], [("red", 4), ("blue", 5)])
    assert sorted(tuple(r) for r in spark.table("colours_v").collect()) == [("blue", 5), ("red", 4)]
    assert v.columns == ["colour", "weight"]
    assert [r.id for r in number_sequence(spark, 16).collect()] == list(range(16))
    inv = file_inventory(spark, sf_small)
    assert inv.columns == ["path", "modificationTime", "length"]
    assert inv.where(F.col("path").endswith("events.parquet")).count() == 1
    a = read_path(spark, f"{sf_small}/events.parquet")
    b = read_path_sql(spark, f"{sf_small}/events.parquet")
    assert a.count() == b.count() == 1000
    assert preview(a, 10).count() == 10
    assert preview(a).count() == 1000


def test_conf_substitution_and_scalar_query_function(spark):
    spark.createDataFrame([(1,), (2,)], "n int").createOrReplaceTempView("two_rows_v")
    spark.conf.set("lakelet.chosen_view", "two_rows_v")
    assert spark.sql("SELECT sum(n) AS s FROM ${lakelet.chosen_view}").first().s == 3
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION largest_n() RETURNS INT RETURN SELECT max(n) FROM two_rows_v")
    assert spark.sql("SELECT largest_n() AS m").first().m == 2


def test_replace_table_from_source(spark, sf_small):
    from lakelet.store.catalog import replace_table_from_source

    v = replace_table_from_source(spark, "nation", sf_small, "nation.parquet")
    assert v.count() == 25
    assert spark.table("nation").count() == 25


def test_name_scan_literal_row_and_temp_view(spark, sf_small):
    from lakelet.plans.taxi import lookup_keys
    from lakelet.sources.fixtures import taxi_trips
    from lakelet.sources.tables import literal_row, read_name

    assert literal_row(spark, "SELECT 'one row' AS msg").first().msg == "one row"
    lookup_keys(taxi_trips(spark, sf_small), view="keyed_trips")
    t = read_name(spark, "keyed_trips")
    assert "rounded_pickup_datetime" in t.columns and "tpep_pickup_datetime" not in t.columns
    assert t.count() == 1000


def test_parse_timestamp(spark):
    from lakelet.functions.timefns import parse_timestamp

    df = spark.createDataFrame([("2024-01-05 10:00:00",), ("05/01/2024 10:00",)], "s string")
    got = df.select(parse_timestamp("s").alias("a"), parse_timestamp("s", "dd/MM/yyyy HH:mm").alias("b")).collect()
    assert got[0].a is not None and got[1].b is not None
    assert got[1].a is None and got[0].b is None  # unparsable text is NULL, not an error


def test_registry_latest_version_defaults_to_one(spark):
    from lakelet.ml.model import ModelRegistry

    reg = ModelRegistry(spark, new_run_dir(spark, "test-registry"))
    assert reg.latest_version("never_logged") == 1
