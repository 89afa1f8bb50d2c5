"""Writers of result tables and run records, and the way back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomtide.sources.config import TrainConfig


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).csv(path, header=True)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_results_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("enforceSchema", False).csv(path, header=True)


def read_coefficients_csv(spark: SparkSession, path: str, homes: Sequence[str]) -> DataFrame:
    """A coefficient table with a column per home, as long rows; text values become NULL."""
    columns = ", ".join(f"`{h}` STRING" for h in homes)
    wide = spark.read.schema(f"term STRING, {columns}").csv(path, header=True)
    return wide.unpivot("term", list(homes), "train_home", "value").select(
        "train_home", "term", F.expr("try_cast(value AS DOUBLE)").alias("value")
    )


def run_parameters(hubs: DataFrame, models: DataFrame, config: TrainConfig) -> DataFrame:
    """One record per home: hubs used, fill, training parameters and the strength used."""
    entries = [F.lit(x) for pair in config.as_map().items() for x in pair]
    used = hubs.groupBy("home").agg(F.array_sort(F.collect_set("hub")).alias("hubs"))
    strength = models.select(F.col("dataset").alias("home"), F.col("c").alias("best_c"))
    return used.join(strength, "home").select(
        "home",
        "hubs",
        F.lit(config.fill).alias("fill"),
        F.create_map(*entries).alias("params"),
        F.lit(config.cv).alias("cv"),
        "best_c",
    )


def write_run_parameters(records: DataFrame, path: str) -> None:
    records.write.mode("overwrite").json(path)
