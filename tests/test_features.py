"""Windowed features: the pre-binned sliding window equals Spark's own ``window``."""

from datetime import datetime

from pyspark.sql import functions as F

from lakelet.operators.windows import dropoff_features, pickup_features
from lakelet.sources.fixtures import taxi_trips


def test_binned_sliding_equals_window(spark, sf_small):
    trips = taxi_trips(spark, sf_small)
    a = pickup_features(trips, "tpep_pickup_datetime", None, None, method="bins")
    b = pickup_features(trips, "tpep_pickup_datetime", None, None, method="window")
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_each_trip_in_four_windows(spark, sf_small):
    trips = taxi_trips(spark, sf_small)
    f = pickup_features(trips, "tpep_pickup_datetime", None, None)
    assert f.agg(F.sum("count_trips_window_1h_pickup_zip")).first()[0] == 4 * trips.count()


def test_null_timestamp_in_no_window(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1, 0, 5), 10.0), (1, None, 99.0)],
        "pickup_zip long, tpep_pickup_datetime timestamp_ntz, fare_amount double",
    )
    f = pickup_features(df, "tpep_pickup_datetime", None, None).collect()
    assert len(f) == 4
    assert all(r.count_trips_window_1h_pickup_zip == 1 and r.mean_fare_window_1h_pickup_zip == 10.0 for r in f)


def test_dropoff_schema(spark, sf_small):
    f = dropoff_features(taxi_trips(spark, sf_small), "tpep_dropoff_datetime", None, None)
    assert [(x.name, x.dataType.simpleString()) for x in f.schema.fields] == [
        ("zip", "int"),
        ("ts", "int"),
        ("yyyy_mm", "string"),
        ("count_trips_window_30m_dropoff_zip", "int"),
        ("dropoff_is_weekend", "int"),
    ]


def test_complete_windows_merge_exactly(spark, sf_small):
    """With complete windows, two adjacent ranges together equal one run over both."""
    trips = taxi_trips(spark, sf_small)
    a = pickup_features(trips, "tpep_pickup_datetime", datetime(2024, 1, 2), datetime(2024, 1, 10), complete_windows=True)
    b = pickup_features(trips, "tpep_pickup_datetime", datetime(2024, 1, 10), datetime(2024, 1, 20), complete_windows=True)
    whole = pickup_features(trips, "tpep_pickup_datetime", datetime(2024, 1, 2), datetime(2024, 1, 20), complete_windows=True)
    ab = a.unionByName(b)
    assert ab.count() == whole.count() > 0
    assert ab.exceptAll(whole).count() == 0
    d = dropoff_features(trips, "tpep_dropoff_datetime", datetime(2024, 1, 2), datetime(2024, 1, 10), complete_windows=True)
    d2 = dropoff_features(trips, "tpep_dropoff_datetime", datetime(2024, 1, 10), datetime(2024, 1, 20), complete_windows=True)
    dw = dropoff_features(trips, "tpep_dropoff_datetime", datetime(2024, 1, 2), datetime(2024, 1, 20), complete_windows=True)
    assert d.unionByName(d2).exceptAll(dw).count() == 0 and dw.count() == d.count() + d2.count()


def test_taxi_month_expression_matches_written_partitions(spark, sf_small):
    from lakelet.plans.taxi import EXCLUDE_COLUMNS, LABEL, build_feature_tables, feature_lookups, lookup_keys
    from lakelet.session import new_run_dir
    from lakelet.store.feature_store import FeatureStore

    store = FeatureStore(spark, new_run_dir(spark, "test-prune"))
    trips = taxi_trips(spark, sf_small)
    p, d = build_feature_tables(spark, trips, store)
    data = lookup_keys(trips)
    full = store.create_training_set(data, feature_lookups(p, d), LABEL, EXCLUDE_COLUMNS).load_df()
    pruned = store.create_training_set(data, feature_lookups(p, d), LABEL, EXCLUDE_COLUMNS, prune_partitions=True).load_df()
    assert full.count() == pruned.count() == 1000
    assert full.exceptAll(pruned).count() == 0
    assert full.where("mean_fare_window_1h_pickup_zip IS NOT NULL").count() > 900
