"""Model and scoring: every input row scored, no NULL prediction, better than the mean."""

from pyspark.sql import functions as F

from lakelet.plans.taxi import train_and_score


def test_train_and_score(spark, sf_small):
    scored, metrics = train_and_score(spark, sf_small, max_iter=10)
    assert scored.columns[0] == "predicted_fare_amount"
    assert scored.count() == spark.read.parquet(f"{sf_small}/events.parquet").count()
    assert scored.where(F.col("predicted_fare_amount").isNull()).count() == 0
    assert metrics["rmse"] < metrics["rmse_mean_predictor"]


def test_rounds_read_a_row_for_equal_features(spark, monkeypatch):
    """The boosting rounds read rows of distinct binned features, whatever the number of trips; means are learnt."""
    from types import SimpleNamespace

    from lakelet.ml import model

    read = []
    real = model.GBTRegressor.fit
    monkeypatch.setattr(model.GBTRegressor, "fit", lambda self, df, *a: read.append(df.agg(F.count("*"), F.sum("__rows")).first()) or real(self, df, *a))
    rows = [(i % 7 if i % 11 else None, 0.5 * (i % 3), 10.0 * (i % 7) + (i % 2)) for i in range(1000)]
    df = spark.createDataFrame(rows, "zip int, share double, fare double")
    fitted, metrics = model.train_regressor(SimpleNamespace(label="fare", df=df, load_df=lambda: df), max_iter=5)
    assert read[0][0] <= 24 < read[0][1]
    assert 600 < read[0][1] < 850  # every training row counts
    assert metrics["rmse"] < 0.7 * metrics["rmse_mean_predictor"]
    wide = spark.createDataFrame([(i * 1.0, i // 500 * 10.0) for i in range(1000)], "x double, fare double")
    fitted, metrics = model.train_regressor(SimpleNamespace(label="fare", df=wide, load_df=lambda: wide), max_iter=5)
    assert read[1][0] <= model.BINS + 1 and metrics["rmse"] < 2
    assert fitted.transform(spark.createDataFrame([(None,), (-5.0,), (5000.0,)], "x double")).where("prediction IS NOT NULL").count() == 3


def test_tasks_of_boosting_rounds_go_by_rows(spark, monkeypatch):
    """However many partitions shuffles are dealt to, a round starts a task for so many rows, and all rows count."""
    from types import SimpleNamespace

    from lakelet.ml import model

    read = []
    real = model.GBTRegressor.fit
    monkeypatch.setattr(model.GBTRegressor, "fit", lambda self, df, *a: read.append((df.rdd.getNumPartitions(), df.agg(F.sum("__rows")).first()[0])) or real(self, df, *a))
    df = spark.createDataFrame([(i % 13, float(i % 7), 10.0 * (i % 7) + i % 13) for i in range(1000)], "zip int, share double, fare double")
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        model.train_regressor(SimpleNamespace(label="fare", df=df, load_df=lambda: df), max_iter=2)
        monkeypatch.setattr(model, "TASK_ROWS", 30)
        model.train_regressor(SimpleNamespace(label="fare", df=df, load_df=lambda: df), max_iter=2)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    (tasks, rows), (more, same) = read
    assert tasks == 1 and 3 <= more <= 4  # 91 rows of distinct features at most
    assert rows == same > 600
