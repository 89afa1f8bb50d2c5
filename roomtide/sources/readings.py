"""Readers: hub files, ground truth, inference tables and the ``events`` sensor view."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.functions.numeric import nan_to_null
from roomtide.schemas import CHANNELS, ENV, HUB_CSV

HUB_FILE = r"(H\d+)([A-Z]S\d+)(?:_prob)?\.csv$"


def _from_file_name(group: int) -> Column:
    return F.regexp_extract(F.col("_metadata.file_name"), HUB_FILE, group)


def read_hub_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Hub CSV files such as ``H1RS1.csv``; home and hub come from the file name.

    Columns are found by name, in any order, and others are ignored.  The headers are read
    first; files that share one are read together, and the groups are united by name.
    """
    groups = csv_headers(spark, paths).groupBy("header").agg(F.collect_list("path").alias("paths")).collect()
    if len(groups) < 2:
        return _hub_csv(spark, paths)
    # As many plans as there are different headers; a file list is what Spark's own listing holds.
    return reduce(DataFrame.unionByName, [_hub_csv(spark, [unquote(p) for p in g.paths])
                                          for g in sorted(groups, key=lambda g: g.header)])


def csv_headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path`` and ``header`` of every CSV file: its line that names the column ``timestamp``."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("header"))
    return lines.where(F.col("header").rlike(r"(^|[,\uFEFF])\s*\"?timestamp\"?\s*(,|$)"))


def _hub_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    text = spark.read.option("enforceSchema", False).csv(paths, header=True)
    typed = {f.name: F.col(f.name).cast(f.dataType) for f in HUB_CSV.fields}
    return text.select(
        _from_file_name(1).alias("home"),
        _from_file_name(2).alias("hub"),
        typed["timestamp"].alias("ts"),
        *[nan_to_null(typed[c]).alias(c) for c in (*CHANNELS, "occupied")],
    )


def read_truth_csv(
    spark: SparkSession, path: str, home: str, persons: Sequence[str] | None = None
) -> DataFrame:
    """Ground truth of one home: a 0/1 column per person and ``occupied``.

    Without ``persons``, every column but the time and the label is a person.
    """
    text = spark.read.option("enforceSchema", False).csv(path, header=True)
    if persons is None:
        persons = [c for c in text.columns if c not in ("timestamp", "occupied")]
    marks = [F.col(f"`{c}`").cast("int").alias(c) for c in (*persons, "occupied")]
    return text.select(
        F.lit(home).alias("home"), F.col("timestamp").cast("timestamp_ntz").alias("ts"), *marks
    )


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    """Ingested readings, Parquet partitioned by home."""
    return spark.read.parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Inference table of a database; filters and column choice are pushed to it."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def select_channels(
    readings: DataFrame, channel: str, environment: bool = True
) -> DataFrame:
    """Keep one of audio and image, optionally the environment, and the label."""
    env = ENV if environment else ()
    return readings.select("home", "hub", "ts", channel, *env, "occupied")


def select_hub(inferences: DataFrame, hub: str, channel: str) -> DataFrame:
    """Rows of one hub with one channel; the filter reaches the scan."""
    return inferences.where(F.col("hub") == hub).select(
        "home", "day", "hr_min_sec", "hub", channel, "occupied"
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def sensor_view(events: DataFrame) -> DataFrame:
    """Hub readings derived from ``events``: users become hubs, event types channels."""
    strength = "least(value / 100, 1.0D)"
    # Which event type stands for which channel.
    by_type = {
        "audio": "click", "img": "view", "temp": "purchase", "rh": "signup", "light": "error",
    }
    channels = {
        c: f"CASE WHEN event_type = '{kind}' THEN {strength} END" for c, kind in by_type.items()
    }
    channels["co2eq"] = f"0.5D * {strength}"
    return events.selectExpr(
        "concat('H', user_id % 6 + 1) AS home",
        "concat('RS', user_id div 6 % 5 + 1) AS hub",
        "ts",
        *[f"{channels[c]} AS {c}" for c in CHANNELS],
        "cast(value > 30 AS DOUBLE) AS occupied",
    )


def truth_view(events: DataFrame) -> DataFrame:
    """Per-person ground truth derived from ``events``; errors carry no truth."""
    home = F.concat(F.lit("H"), F.col("user_id") % 6 + 1)
    kind = F.col("event_type")

    def person(*kinds: str) -> Column:
        return F.max((kind.isin(*kinds) & (F.col("value") > 20)).cast("int"))

    return (
        events.where(kind != "error")
        .groupBy(home.alias("home"), "ts")
        .agg(
            person("click", "view").alias("person1"),
            person("purchase").alias("person2"),
            person("signup", "click").alias("person3"),
            F.max((F.col("value") > 30).cast("int")).alias("occupied"),
        )
    )


def inference_view(bins: DataFrame) -> DataFrame:
    """Hub inferences in {-1, 0, 1}; -1 marks a bin without readings."""

    def state(channel: str) -> Column:
        seen = (F.coalesce(F.col(channel), F.lit(0.0)) > 0.5).cast("int")
        return F.when(F.col("n_readings") == 0, -1).otherwise(seen)

    return bins.select(
        "home",
        "hub",
        F.to_date("ts").alias("day"),
        F.date_format("ts", "HH:mm:ss").alias("hr_min_sec"),
        state("audio").alias("audio"),
        state("img").alias("img"),
        "occupied",
    )
