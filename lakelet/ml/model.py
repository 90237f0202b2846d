"""Training, model registry on files, batch scoring (ML2-ML9, JN4).

Training runs on Spark ML -- the data never goes through the driver.  Looked-up
features are NULL where no feature row exists; boosted trees in Spark refuse NaN,
so each feature gets a 0/1 miss flag and a mean-imputed value, all inside the
saved pipeline so scoring applies exactly the same steps.
"""

from __future__ import annotations

import json
import math
from datetime import datetime, timezone

from pyspark.ml import Pipeline as MLPipeline
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, QuantileDiscretizer, SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelet.session import new_run_dir, shared_dir
from lakelet.store.feature_store import FeatureLookup, FeatureStore, TrainingSet
from lakelet.store.versions import ensure_table

# Fixed values from the reference's training cell: seed of the split, 100 boosting
# rounds, trees of 32 leaves (depth 5), squared error measured as RMSE.
SPLIT_SEED = 123
TRAIN_SHARE = 0.75
ROUNDS = 100
DEPTH = 5
#: values of a feature that the trees tell apart: Spark's default of ``maxBins``
BINS = 32
#: rows of a task of a boosting round: the more are read in about the time it takes to start a task or two, the fewer
#: are not worth a core of their own
TASK_ROWS, CORE_ROWS = 100_000, 10_000

_REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)


def _feature_stages(features: list[str]) -> tuple[list, list[str], list[str]]:
    casts = ", ".join(f"CAST(`{c}` AS DOUBLE) AS `__x_{c}`" for c in features)
    flags = ", ".join(f"CAST(`{c}` IS NULL AS DOUBLE) AS `__miss_{c}`" for c in features)
    prep = SQLTransformer(statement=f"SELECT *, {casts}, {flags} FROM __THIS__")
    imputed = [f"__imp_{c}" for c in features]
    imputer = Imputer(inputCols=[f"__x_{c}" for c in features], outputCols=imputed, strategy="mean")
    return [prep, imputer], imputed, [f"__miss_{c}" for c in features]


def _bins(train: DataFrame, columns: list[str], wide: list[str]) -> tuple[list, list[str]]:
    """Stages that put the ``wide`` columns into ``BINS`` quantiles, and the columns the trees then read."""
    if not wide:
        return [], columns
    names = {c: f"__bin_{c}" for c in wide}
    cut = QuantileDiscretizer(inputCols=wide, outputCols=list(names.values()), numBuckets=BINS, handleInvalid="keep").fit(train)
    return [cut], [names.get(c, c) for c in columns]


def train_regressor(
    training_set: TrainingSet,
    seed: int = SPLIT_SEED,
    train_share: float = TRAIN_SHARE,
    max_iter: int = ROUNDS,
    max_depth: int = DEPTH,
) -> tuple[PipelineModel, dict]:
    """ML2-ML5: random split, boosted-tree regression on the label, RMSE on the held-out part.

    Rows without a label cannot be learnt from; the metrics count them.  The split goes by a hash of the
    row, so it is the same on any cluster and after any retry.
    """
    label = training_set.label
    spark = training_set.df.sparkSession
    # cut the lineage of the lookup joins once: training passes read these files, not the joins
    path = f"{new_run_dir(spark, 'training-set')}/rows"
    training_set.load_df().write.parquet(path)
    rows = spark.read.parquet(path)
    known = F.col(label).isNotNull()
    features = [c for c in rows.columns if c != label]
    place = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in rows.columns]), F.lit(10_000))
    in_train = place < int(train_share * 10_000)
    df = rows.where(known)
    train, test = df.where(in_train), df.where(~in_train)
    # one pass for all that the metrics count: rows without a label, and the error of the training mean
    y, held = F.col(label).cast("double"), known & ~in_train
    s = rows.agg(F.count_if(~known).alias("unlabelled"), F.count_if(known).alias("n"), F.count_if(held).alias("n_test"), F.avg(F.when(known & in_train, y)).alias("mean"),
                 F.avg(F.when(held, y)).alias("test_mean"), F.avg(F.when(held, y * y)).alias("test_square")).first()
    baseline = math.sqrt(max(0.0, s["test_square"] - 2 * s["mean"] * s["test_mean"] + s["mean"] ** 2)) if s["n_test"] and s["mean"] is not None else 0.0
    stages, imputed, missed = _feature_stages(features)
    prepared = MLPipeline(stages=stages).fit(train)
    filled = prepared.transform(train)
    distinct = filled.agg(*[F.approx_count_distinct(c).alias(c) for c in imputed]).first()
    cuts, columns = _bins(filled, imputed, [c for c in imputed if distinct[c] > BINS])
    # trees read features in bins: training rows of the same bins are one row, their mean label weighted by their
    # number, which gives each split the same gain; the boosting rounds read these rows, not the files
    inputs = columns + missed
    assembler = VectorAssembler(inputCols=inputs, outputCol="__features")
    grouped = (MLPipeline(stages=cuts).fit(filled).transform(filled).groupBy(*inputs)
               .agg(F.avg(F.col(label).cast("double")).alias(label), F.count("*").cast("double").alias("__rows")))
    vectors = assembler.transform(grouped).select(label, "__rows", "__features").persist()
    gbt = GBTRegressor(labelCol=label, featuresCol="__features", weightCol="__rows", maxIter=max_iter, maxDepth=max_depth, maxBins=BINS, seed=seed)
    try:
        # a round is a job for each level of its tree, so hundreds of jobs follow: their tasks go by the rows there
        # are, and by the cores for few rows, whatever number of partitions the grouping was dealt to
        n = vectors.count()
        trees = gbt.fit(vectors.coalesce(max(1, -(-n // TASK_ROWS), min(spark.sparkContext.defaultParallelism, -(-n // CORE_ROWS)))))
    finally:
        vectors.unpersist()
    model = PipelineModel([*prepared.stages, *cuts, assembler, trees])
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    rmse = ev.evaluate(model.transform(test))
    return model, {"rmse": float(rmse), "rmse_mean_predictor": baseline, "features": features, "rows_without_label": s["unlabelled"],
                   "held_out_share": s["n_test"] / s["n"] if s["n"] else 0.0}


class ModelRegistry:
    """ML6-ML7: versioned models on files, each saved with the lookup spec of its training set."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or shared_dir(spark, "models")).rstrip("/")
        self.meta = f"{self.root}/_registry"
        ensure_table(spark, self.meta, _REGISTRY_SCHEMA)

    def latest_version(self, name: str) -> int:
        """Highest registered version, at least 1."""
        v = (
            self.spark.read.schema(_REGISTRY_SCHEMA).parquet(self.meta)
            .where(F.col("name") == name)
            .agg(F.coalesce(F.max("version"), F.lit(1)).alias("v"))
            .first()[0]
        )
        return int(v)

    def _next_version(self, name: str) -> int:
        v = self.spark.read.schema(_REGISTRY_SCHEMA).parquet(self.meta).where(F.col("name") == name).agg(F.max("version")).first()[0]
        return int(v or 0) + 1

    def log_model(self, name: str, model: PipelineModel, training_set: TrainingSet, rmse: float | None = None) -> str:
        version = self._next_version(name)
        path = f"{self.root}/{name}/v{version}"
        model.write().overwrite().save(f"{path}/model")
        self.spark.createDataFrame([(training_set.spec_json(),)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/spec"
        )
        row = (name, version, path, rmse, datetime.now(timezone.utc))
        self.spark.createDataFrame([row], _REGISTRY_SCHEMA).coalesce(1).write.mode("append").parquet(self.meta)
        return f"models:/{name}/{version}"

    def resolve(self, uri: str) -> str:
        if not uri.startswith("models:/"):
            return uri
        name, version = uri[len("models:/"):].split("/")
        rows = (
            self.spark.read.schema(_REGISTRY_SCHEMA).parquet(self.meta)
            .where((F.col("name") == name) & (F.col("version") == int(version)))
            .select("path").collect()
        )
        if not rows:
            raise KeyError(uri)
        return rows[0][0]

    def load(self, uri: str) -> tuple[PipelineModel, dict]:
        path = self.resolve(uri)
        spec = json.loads(self.spark.read.text(f"{path}/spec").first()[0])
        return PipelineModel.load(f"{path}/model"), spec


def score_batch(
    store: FeatureStore, registry: ModelRegistry, model_uri: str, df: DataFrame, prune_partitions: bool = False
) -> DataFrame:
    """ML8/JN4: look up the model's features for ``df`` (from the saved spec), append ``prediction``.

    Output: the input columns, the looked-up features and ``prediction``; one row per input row.
    ``prune_partitions`` reads only the feature partitions the batch can match (a recent slice).
    """
    model, spec = registry.load(model_uri)
    lookups = [FeatureLookup(**x) for x in spec["feature_lookups"]]
    with_features = store.lookup(df, lookups, prune_partitions)
    keep = with_features.columns
    return model.transform(with_features).select(*keep, "prediction")


# Fixed value: the column order of the reference's prediction display.
PREDICTION_COLUMNS = [
    "prediction",
    "fare_amount",
    "trip_distance",
    "pickup_zip",
    "dropoff_zip",
    "rounded_pickup_datetime",
    "rounded_dropoff_datetime",
    "mean_fare_window_1h_pickup_zip",
    "count_trips_window_1h_pickup_zip",
    "count_trips_window_30m_dropoff_zip",
    "dropoff_is_weekend",
]


def present_predictions(scored: DataFrame, columns: list[str] = PREDICTION_COLUMNS) -> DataFrame:
    """ML9: the columns in display order, the prediction as ``predicted_fare_amount`` with 2 digits."""
    shown = {"prediction": F.round("prediction", 2).alias("predicted_fare_amount")}
    return scored.select(*[shown.get(c, F.col(c)) for c in columns])
