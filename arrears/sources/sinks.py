"""Writing results, saving and loading fitted models with their metrics."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def save_table(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Materialise ``df`` as Parquet and return the written table."""
    path = f"{folder.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}")


def export_csv(df: DataFrame, folder: str, name: str) -> str:
    """Export ``df`` as CSV with a header; every executor writes its own part."""
    path = f"{folder.rstrip('/')}/{name}.csv"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def save_model(model: PipelineModel, metrics: DataFrame, folder: str, name: str) -> None:
    """Save a fitted pipeline and, beside it, the table of its metrics."""
    model.write().overwrite().save(f"{folder.rstrip('/')}/{name}/model")
    save_table(metrics, folder, f"{name}/metrics")


def load_model(spark: SparkSession, folder: str, name: str) -> tuple[PipelineModel, DataFrame]:
    model = PipelineModel.load(f"{folder.rstrip('/')}/{name}/model")
    return model, load_table(spark, folder, f"{name}/metrics")
