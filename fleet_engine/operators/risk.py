"""Predictive maintenance: features, split, training, scoring, metrics, model versions."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleet_engine.workspace import drop_folder, run_dir

FEATURES = ["engine_temperature_celsius", "temp_variance"]


def risk_features(silver: DataFrame, threshold: float = 110.0) -> DataFrame:
    """Label (hotter than ``threshold``) and the scaled temperature feature."""
    temp = F.col("engine_temperature_celsius")
    return silver.withColumn("is_at_risk", F.when(temp > threshold, 1).otherwise(0)).withColumn("temp_variance", temp * 1.5)


def split(df: DataFrame, id: str, share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of id and seed: the same rows on every run, whatever the partitioning."""
    digest = F.md5(F.concat(F.col(id).cast("string"), F.lit(f":{seed}")))
    slot = F.conv(F.left(digest, F.lit(7)), 16, 10).cast("long") % 10_000
    marked = df.withColumn("_slot", slot)
    cut = round(share * 10_000)
    return marked.filter(F.col("_slot") < cut).drop("_slot"), marked.filter(F.col("_slot") >= cut).drop("_slot")


def train_risk(df: DataFrame, trees: int = 100, seed: int = 42, depth: int = 5) -> PipelineModel:
    """Random forest; training passes exchange histograms per tree node, not rows.

    The model is returned as written and read again: a freshly fitted one holds its training summary and with it the session, which cannot go to
    the executors once the session observes a write.
    """
    forest = RandomForestClassifier(featuresCol="features", labelCol="is_at_risk", predictionCol="predicted_risk_class",
                                    numTrees=trees, seed=seed, maxDepth=depth)
    path = run_dir(df.sparkSession, "forest")
    Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(df).write().save(path)
    model = PipelineModel.load(path)
    drop_folder(df.sparkSession, path)
    return model


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    return (model.transform(df).withColumn("predicted_risk_class", F.col("predicted_risk_class").cast("int"))
            .drop("features", "rawPrediction", "probability"))


def class_metrics(pred: DataFrame, label: str = "is_at_risk", predicted: str = "predicted_risk_class") -> DataFrame:
    """Accuracy, and precision of class 1 (0 when it is never predicted), in one aggregate."""
    hit = F.col(label) == F.col(predicted)
    positives = F.count_if(F.col(predicted) == 1)
    return pred.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(hit.cast("int")), 6).alias("accuracy"),
                    F.when(positives > 0, F.round(F.count_if(hit & (F.col(predicted) == 1)) / positives, 6))
                    .otherwise(F.lit(0.0)).alias("precision"))


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def register_model(spark: SparkSession, model: PipelineModel, root: str, name: str, version: str) -> bool:
    """Save a model version; False and no change when the version exists already."""
    path = f"{root}/{name}/{version}"
    if _exists(spark, path):
        return False
    model.write().save(path)
    return True


def load_model(root: str, name: str, version: str) -> PipelineModel:
    return PipelineModel.load(f"{root}/{name}/{version}")
