"""Home and training configuration as small tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The homes, their system colour, date ranges, hubs and hub thresholds.
HOMES = {
    "H1": ("red", [("2019-11-26", "2019-12-25")],
           {1: 0.3, 2: 0.5, 3: 0.3, 4: 0.3, 5: 0.3}),
    "H2": ("red", [("2019-03-13", "2019-03-29")], {1: 0.3, 2: 0.3, 4: 0.3, 5: 0.3}),
    "H3": ("red", [("2019-07-23", "2019-08-04"), ("2019-08-15", "2019-09-05")],
           {1: 0.3, 2: 0.2, 3: 0.4, 4: 0.5, 5: 0.5}),
    "H4": ("red", [("2019-05-01", "2019-05-12"), ("2019-05-17", "2019-05-21")],
           {1: 0.3, 2: 0.4, 3: 0.35, 4: 0.3, 5: 0.3}),
    "H5": ("red", [("2019-06-07", "2019-06-21")],
           {1: 0.3, 2: 0.5, 3: 0.6, 4: 0.3, 5: 0.4}),
    "H6": ("black", [("2019-10-12", "2019-11-02"), ("2019-11-20", "2019-12-05")],
           {2: 0.3, 3: 0.3, 4: 0.5, 5: 0.6}),
}


@dataclass(frozen=True)
class TrainConfig:
    """Training parameters of the logistic regression."""

    penalty: str = "l1"
    max_iter: int = 5000
    c: float = 0.1
    n_candidates: int = 30
    cv: bool = False
    n_folds: int = 5
    fill: str = "zeros"
    extra: dict = field(default_factory=dict)

    def as_map(self) -> dict[str, str]:
        strength = (
            {"Cs": str(self.n_candidates)} if self.cv else {"C": str(self.c)}
        )
        return {"penalty": self.penalty, "max_iter": str(self.max_iter), **strength, **self.extra}


def home_config(spark: SparkSession, homes: dict = HOMES) -> DataFrame:
    """One row per home: colour, date ranges, hub numbers and hub thresholds."""
    rows = [
        (home, colour, ranges, list(hubs), {str(n): t for n, t in hubs.items()})
        for home, (colour, ranges, hubs) in homes.items()
    ]
    text = spark.createDataFrame(
        rows,
        "home STRING, system STRING, ranges ARRAY<STRUCT<start:STRING, end:STRING>>, "
        "hubs ARRAY<INT>, thresholds MAP<STRING, DOUBLE>",
    )
    return text.withColumn(
        "ranges", F.expr("transform(ranges, r -> named_struct('start', to_date(r.start), "
                         "'end', to_date(r.end)))")
    )


def home_hubs(config: DataFrame, only: str = "") -> DataFrame:
    """Hub names per home, such as ``RS1``; ``only`` overrides the configured list."""
    hubs = config.select("home", "system", "thresholds", F.explode("hubs").alias("num"))
    named = hubs.select(
        "home",
        F.concat(F.upper(F.substring("system", 1, 1)), F.lit("S"), "num").alias("hub"),
        F.col("thresholds")[F.col("num").cast("string")].alias("zone_threshold"),
    )
    return named.where(F.col("hub") == only) if only else named


def range_days(config: DataFrame) -> DataFrame:
    """Distinct configured days per home."""
    ranges = config.select("home", F.explode("ranges").alias("r"))
    return ranges.select(
        "home", F.explode(F.sequence("r.start", "r.end", F.expr("INTERVAL 1 DAY"))).alias("day")
    ).distinct()


def read_date_ranges(spark: SparkSession, path: str) -> DataFrame:
    """Date ranges from a JSON file ``{home: [[start, end], ..]}``."""
    text = spark.read.text(path, wholetext=True)
    pairs = text.select(
        F.explode(F.from_json("value", "MAP<STRING, ARRAY<ARRAY<STRING>>>")).alias("home", "pairs")
    ).select("home", F.explode("pairs").alias("pair"))
    return pairs.select(
        "home",
        F.to_date(F.trim(F.col("pair")[0])).alias("start"),
        F.to_date(F.trim(F.col("pair")[1])).alias("end"),
    )


def ordered_days(days: DataFrame) -> DataFrame:
    """Number the days of each home and count them."""
    home = Window.partitionBy("home")
    return days.select(
        "home",
        "day",
        F.row_number().over(home.orderBy("day")).alias("day_no"),
        F.count("*").over(home).alias("n_days"),
    )
