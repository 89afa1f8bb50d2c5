"""Times the headline jobs at five-minute bins and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roomtide.operators import metrics  # noqa: E402
from roomtide.operators import timeseries as ts_ops  # noqa: E402
from roomtide.plans import experiments, features  # noqa: E402
from roomtide.operators.splits import assign_split, days_of_spans  # noqa: E402
from roomtide.plans.registry import EXAMPLE_MODELS, FIVE, HOMES, sensor_readings  # noqa: E402
from roomtide.runtime import release, stage  # noqa: E402
from roomtide.sources import readings as readings_source  # noqa: E402
from roomtide.sources.config import TrainConfig  # noqa: E402


def flagship(source):
    cells = features.time_of_day_cells(source, FIVE)
    return metrics.model_metrics(experiments.lookup_counts(cells))


def hub_fusion(source):
    return ts_ops.fuse_hubs(features.filled_bins(source, FIVE))


def rolling_lags(source):
    return ts_ops.fused_with_lags(features.filled_bins(source, FIVE))


def forward_fill(source):
    return features.filled_bins(source, FIVE, "ffill")


def model_free(source):
    bins = ts_ops.label_bins(ts_ops.hub_bins(source, FIVE))
    return experiments.model_free_study(readings_source.inference_view(bins), "img_audio").statistics


def cross_home(source):
    return experiments.cross_home(source, HOMES, FIVE)[0]


def split_sweep(source):
    return experiments.split_sweep(source, HOMES, FIVE)


def cross_validated(source):
    return experiments.cross_home(source, HOMES, FIVE, TrainConfig(cv=True))[0]


def rollout(source):
    """36 series: every home's test days under six models of example weights."""
    ready = features.prepare(source, FIVE)
    staged = stage(ready.features)
    roles = assign_split(days_of_spans(ready.spans))
    coef = [float(w) for w in EXAMPLE_MODELS["H1"]]
    spark = source.sparkSession
    fitted = spark.createDataFrame([(h, coef) for h in HOMES], "dataset STRING, coef ARRAY<DOUBLE>")
    rows = experiments.series_rows(staged, experiments.cross_home_tests(roles, HOMES), fitted)
    return experiments.predict_rollout(rows)


def single_fit(source):
    """One L1 fit on the training days of one home."""
    ready = features.prepare(source.where("home = 'H1'"), FIVE)
    days = assign_split(days_of_spans(ready.spans)).where("role = 'train'").withColumn("dataset", F.col("home"))
    return experiments.train(stage(ready.features), days).models


def factorial(source):
    return experiments.factorial_experiment(source, "audio_None", 5, FIVE).metrics


HEADLINES = {
    f.__name__: f
    for f in (flagship, hub_fusion, rolling_lags, forward_fill, model_free, cross_home,
              split_sweep, factorial, cross_validated, rollout, single_fit)
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("roomtide-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or list(HEADLINES)
    seconds = {}
    for name in wanted:
        source = sensor_readings(spark, folder)
        start = time.perf_counter()
        HEADLINES[name](source).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        release(spark)
    print(
        json.dumps(
            {
                "metric": "headline jobs, five-minute bins",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
