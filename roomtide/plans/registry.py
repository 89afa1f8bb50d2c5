"""Named queries over the driver tables; every one reads ``events`` as sensor readings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.functions.numeric import sig_str
from roomtide.operators import design as designs
from roomtide.operators import effects, factorial, labels, metrics, models, predictors, reports
from roomtide.operators import timeseries as ts_ops
from roomtide.operators.splits import (
    assign_split,
    awake_only,
    common_days,
    days_of_spans,
    keep_days,
    with_directions,
)
from roomtide.plans import experiments
from roomtide.plans import features as feature_plans
from roomtide.runtime import new_folder, stage
from roomtide.schemas import CHANNELS, EFFECT_METRICS, ENV, FEATURES, LAGS
from roomtide.sources import config, sinks
from roomtide.sources import readings as readings_source
from roomtide.sources.config import TrainConfig

HOMES = tuple(f"H{i}" for i in range(1, 7))
HUBS = tuple(f"RS{i}" for i in range(1, 6))
DIGITS = 9
# Hourly bins suit the density of the events at small scale; five minutes at larger.
HOUR = 60
FIVE = 5

# Example coefficients for scoring, one weight per feature and the intercept last.
EXAMPLE_MODELS = {
    "H1": (0.5, 1.5, 0.1, -0.2, 2.0, 0.3, 0.4, 0.2, 1.1,
           3.5, -0.6, 0.1, 0.2, -0.1, -0.1, 0.05, 0.3, -2.5),
    "H2": (3.2, 2.5, 0.0, 0.4, 0.0, 2.9, 0.2, 1.2, 0.6,
           2.8, 0.0, 0.2, 0.0, 0.1, 0.0, -0.2, 0.0, -2.2),
}

Query = Callable[[SparkSession, str], DataFrame]


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def sensor_readings(spark: SparkSession, folder: str) -> DataFrame:
    return readings_source.sensor_view(events(spark, folder))


def rounded(df: DataFrame, columns: Sequence[str], digits: int = DIGITS) -> DataFrame:
    """Round derived doubles, whose last bits depend on the order of summation.

    Adding zero turns the minus zero that rounding may leave into zero.
    """
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) + F.lit(0.0) for c in columns})


def _prepared(spark: SparkSession, folder: str, bin_minutes: int = HOUR):
    return feature_plans.prepare(sensor_readings(spark, folder), bin_minutes)


def _split_days(spans: DataFrame) -> DataFrame:
    return assign_split(days_of_spans(spans))


# --- binning and filling --------------------------------------------------------------


def resample_5min(spark: SparkSession, folder: str) -> DataFrame:
    bins = ts_ops.resample(sensor_readings(spark, folder), FIVE)
    return rounded(bins, ts_ops.VALUES)


def channel_subset(spark: SparkSession, folder: str) -> DataFrame:
    audio = readings_source.select_channels(sensor_readings(spark, folder), "audio", False)
    return rounded(ts_ops.resample(audio, HOUR), ["audio", "occupied"])


def _filled(how: str, bin_minutes: int) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        bins = feature_plans.filled_bins(sensor_readings(spark, folder), bin_minutes, how)
        return rounded(bins.select("home", "hub", "ts", *ts_ops.VALUES), CHANNELS)

    return query


def hub_fusion(spark: SparkSession, folder: str) -> DataFrame:
    bins = feature_plans.filled_bins(sensor_readings(spark, folder), FIVE)
    return rounded(ts_ops.fuse_hubs(bins).drop("pos"), CHANNELS)


# --- features ---------------------------------------------------------------------------


def calendar_features(spark: SparkSession, folder: str) -> DataFrame:
    fused = feature_plans.fused_calendar(sensor_readings(spark, folder), HOUR)
    return rounded(
        fused.select("home", "ts", "day", "weekend", "tod_min", "hr_sin", "hr_cos"),
        ["hr_sin", "hr_cos"],
    )


def _lags(rolling: bool) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        bins = feature_plans.filled_bins(sensor_readings(spark, folder), HOUR)
        return ts_ops.fused_with_lags(bins, rolling).select("home", "ts", "occupied", *LAGS)

    return query


def model_features(spark: SparkSession, folder: str) -> DataFrame:
    """Complete feature rows with their role in the split."""
    ready = _prepared(spark, folder)
    roles = _split_days(ready.spans).select("home", "day", "role")
    rows = feature_plans.complete_rows(ready.features).join(roles, ["home", "day"])
    return rounded(
        rows.select("home", "ts", "role", *FEATURES, "occupied"),
        [*CHANNELS, "hr_sin", "hr_cos"],
    )


def environment_dropped(spark: SparkSession, folder: str) -> DataFrame:
    fused = feature_plans.fused_calendar(sensor_readings(spark, folder), HOUR)
    kept = fused.drop(*ENV).select("home", "ts", "audio", "img", "occupied", "weekend")
    return rounded(kept, ["audio", "img"])


# --- splits -----------------------------------------------------------------------------


def day_split(spark: SparkSession, folder: str) -> DataFrame:
    spans = ts_ops.hub_spans(sensor_readings(spark, folder), HOUR)
    return _split_days(spans).select("home", "day", "day_no", "role")


def split_sweep_days(spark: SparkSession, folder: str) -> DataFrame:
    spans = ts_ops.hub_spans(sensor_readings(spark, folder), HOUR)
    days = with_directions(assign_split(days_of_spans(spans), experiments.SWEEP))
    return days.select("home", "day", "split", "direction", "role")


def train_day_rows(spark: SparkSession, folder: str) -> DataFrame:
    ready = sensor_readings(spark, folder)
    spans = ts_ops.hub_spans(ready, HOUR)
    fused = feature_plans.fused_calendar(ready, HOUR, spans)
    train = _split_days(spans).where(F.col("role") == "train")
    return keep_days(fused, train).select("home", "ts", "day", "occupied")


def _busy_days(inferences: DataFrame) -> DataFrame:
    """Days on which some hub saw more than one positive image bin."""
    per_hub = inferences.groupBy("home", "hub", "day").agg(F.count_if(F.col("img") == 1).alias("n"))
    return per_hub.where(F.col("n") > 1).select("home", "day").distinct()


def day_intersection(spark: SparkSession, folder: str) -> DataFrame:
    table = _inferences(spark, folder)
    return common_days(table.where(F.col("audio") == 1), _busy_days(table))


def awake_samples(spark: SparkSession, folder: str) -> DataFrame:
    table = awake_only(_inferences(spark, folder), "00:00:00", "06:00:00")
    return table.groupBy("home", "hub").agg(
        F.count("*").alias("n_samples"), F.sum("occupied").alias("n_occupied")
    )


# --- predictors -------------------------------------------------------------------------


def or_baseline(spark: SparkSession, folder: str) -> DataFrame:
    bins = feature_plans.filled_bins(sensor_readings(spark, folder), HOUR)
    scored = predictors.or_baseline(ts_ops.fuse_hubs(bins))
    return rounded(
        scored.select("home", "ts", "prob_ai", "pred_ai", "prob_aie", "pred_aie", "occupied"),
        ["prob_ai", "prob_aie"],
    )


def _with_roles(spark: SparkSession, folder: str) -> DataFrame:
    source = sensor_readings(spark, folder)
    spans = ts_ops.hub_spans(source, HOUR)
    fused = feature_plans.fused_calendar(source, HOUR, spans)
    return fused.join(_split_days(spans).select("home", "day", "role"), ["home", "day"])


def nonparametric_model(spark: SparkSession, folder: str) -> DataFrame:
    train = _with_roles(spark, folder).where(F.col("role") == "train")
    return rounded(predictors.time_of_day_model(train), ["prob_np"])


def nonparametric_pred(spark: SparkSession, folder: str) -> DataFrame:
    rows = stage(
        _with_roles(spark, folder).select("home", "ts", "weekend", "tod_min", "occupied", "role")
    )
    model = predictors.time_of_day_model(rows.where(F.col("role") == "train"))
    found = predictors.time_of_day_predict(rows.where(F.col("role") == "test"), stage(model))
    return rounded(found.select("home", "ts", "occupied", "prob_np", "pred_np"), ["prob_np"])


def example_models(spark: SparkSession) -> DataFrame:
    rows = [(name, [float(w) for w in weights]) for name, weights in EXAMPLE_MODELS.items()]
    return spark.createDataFrame(rows, "dataset STRING, coef ARRAY<DOUBLE>")


def _example_rows(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Test rows of every home under the example models, and the lookup models."""
    ready = _prepared(spark, folder)
    features = stage(ready.features)
    roles = _split_days(ready.spans)
    pairs = spark.createDataFrame(
        [(m, h) for m in EXAMPLE_MODELS for h in HOMES], "dataset STRING, home STRING"
    )
    tests = roles.where(F.col("role") == "test").join(pairs, "home").select(
        experiments.joined_id("dataset", "home").alias("series_id"), "dataset", "home", "day"
    )
    rows = experiments.series_rows(features, tests, example_models(spark))
    train = features.join(
        roles.where(F.col("role") == "train").select("home", "day"), ["home", "day"]
    )
    lookup = predictors.time_of_day_model(train).withColumnRenamed("home", "dataset")
    return rows, lookup


def score_true_lags(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = _example_rows(spark, folder)
    scored = predictors.score_true_lags(rows.where(F.col("series_pos").isNotNull()))
    return rounded(
        scored.select(
            F.col("dataset").alias("train"), F.col("home").alias("test"), "ts", "series_pos",
            "occupied", "prob_gt", "pred_gt",
        ),
        ["prob_gt"],
    )


def predictor_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of the four non-recurrent predictors for the example models."""
    rows, lookup = _example_rows(spark, folder)
    predictions = experiments.predict_instant(rows, stage(lookup))
    names = {k: v for k, v in experiments.PREDICTORS.items() if v != "pred_ar"}
    scored = experiments.experiment_metrics(predictions, names)
    return rounded(scored, list(metrics.DIGITS))


def _all_example_predictions(spark: SparkSession, folder: str) -> DataFrame:
    rows, lookup = _example_rows(spark, folder)
    return experiments.predict_all(rows, experiments.Trained(example_models(spark), stage(lookup)))


def example_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """All five predictors row by row for the example models."""
    predictions = _all_example_predictions(spark, folder)
    return rounded(predictions, [c for c in predictions.columns if c.startswith("prob")])


def example_cross_home(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of all five predictors for every example model on every home."""
    scored = experiments.experiment_metrics(_all_example_predictions(spark, folder))
    return rounded(scored, list(metrics.DIGITS))


def rollout(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = _example_rows(spark, folder)
    return rounded(experiments.predict_rollout(rows), ["prob_ar"])


# --- metrics and reports ----------------------------------------------------------------


def _home_metrics(spark: SparkSession, folder: str) -> DataFrame:
    cells = feature_plans.time_of_day_cells(sensor_readings(spark, folder), HOUR)
    return metrics.model_metrics(experiments.lookup_counts(cells))


def metrics_by_home(spark: SparkSession, folder: str) -> DataFrame:
    """How well weekday and time of day predict occupancy in each home."""
    return rounded(_home_metrics(spark, folder), list(metrics.DIGITS))


def metrics_sigdigits(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.to_report_digits(_home_metrics(spark, folder))


def confusion_table(spark: SparkSession, folder: str) -> DataFrame:
    bins = feature_plans.filled_bins(sensor_readings(spark, folder), HOUR)
    scored = predictors.or_baseline(ts_ops.fuse_hubs(bins))
    return metrics.confusion_table(scored, ["home"], prediction="pred_ai")


def _matrix(spark: SparkSession, folder: str) -> DataFrame:
    cells = stage(feature_plans.time_of_day_cells(sensor_readings(spark, folder), HOUR))
    return metrics.model_metrics(experiments.lookup_matrix(cells, HOMES)).withColumn(
        "function", F.lit("Nonparametric")
    )


def cross_home_nonparametric(spark: SparkSession, folder: str) -> DataFrame:
    return reports.cross_home_order(rounded(_matrix(spark, folder), list(metrics.DIGITS)))


def split_direction_nonparametric(spark: SparkSession, folder: str) -> DataFrame:
    """Lookup predictor for every split ratio and direction, from counted cells."""
    source = sensor_readings(spark, folder)
    spans = ts_ops.hub_spans(source, HOUR)
    fused = feature_plans.fused_calendar(source, HOUR, spans)
    days = with_directions(assign_split(days_of_spans(spans), experiments.SWEEP))
    per_day = fused.groupBy("home", "day", "weekend", "tod_min").agg(
        F.count_if(F.col("occupied") == 0).alias("n0"),
        F.count_if(F.col("occupied") == 1).alias("n1"),
    )

    def total(role: str, count: str) -> Column:
        return F.sum(F.when(F.col("role") == role, F.col(count)).otherwise(0))

    keys = ("home", "split", "direction")
    cells = (
        per_day.join(days, ["home", "day"])
        .groupBy(*keys, "weekend", "tod_min")
        .agg(
            *[
                total(role, f"n{y}").alias(f"{role}_{y}")
                for role in ("train", "test")
                for y in (0, 1)
            ]
        )
    )
    counts = experiments.lookup_counts(cells, keys)
    scored = metrics.model_metrics(counts).withColumn("function", F.lit("Nonparametric"))
    return reports.split_order(rounded(scored, list(metrics.DIGITS)))


def pivot_train_test(spark: SparkSession, folder: str) -> DataFrame:
    table = reports.pivot_train_test(_matrix(spark, folder), "Nonparametric", "Accuracy", HOMES)
    return rounded(table, HOMES)


def f1_pair_pivot(spark: SparkSession, folder: str) -> DataFrame:
    labelled = reports.with_f1_label(_matrix(spark, folder))
    return reports.pivot_train_test(labelled, "Nonparametric", "F1s", HOMES)


def daily_occupancy(spark: SparkSession, folder: str) -> DataFrame:
    source = sensor_readings(spark, folder)
    spans = ts_ops.hub_spans(source, HOUR)
    fused = feature_plans.fused_calendar(source, HOUR, spans)
    return rounded(reports.daily_occupancy(fused, _split_days(spans)), ["occupied"])


# --- relabelling ------------------------------------------------------------------------


def _matched(spark: SparkSession, folder: str) -> DataFrame:
    table = events(spark, folder)
    return labels.match_truth(
        readings_source.sensor_view(table), readings_source.truth_view(table)
    )


def relabel_hubs(spark: SparkSession, folder: str) -> DataFrame:
    return labels.relabel(_matched(spark, folder)).select("home", "hub", "ts", *ts_ops.VALUES)


def label_diff_wide(spark: SparkSession, folder: str) -> DataFrame:
    return labels.label_difference_wide(_matched(spark, folder), HUBS)


# --- factorial studies ------------------------------------------------------------------


def _hubs(spark: SparkSession, folder: str) -> DataFrame:
    return sensor_readings(spark, folder).select("home", "hub").distinct()


def distinct_hubs(spark: SparkSession, folder: str) -> DataFrame:
    return readings_source.distinct_values(sensor_readings(spark, folder), "hub")


def _design(level: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        hubs = _hubs(spark, folder)
        runs = designs.long_design(designs.design(hubs, level), hubs)
        return designs.hub_columns(runs, HUBS)

    return query


def hub_modalities(spark: SparkSession, folder: str) -> DataFrame:
    hubs = _hubs(spark, folder)
    runs = designs.long_design(designs.design(hubs, "half"), hubs)
    return designs.assign_channels(runs, "audio_None").select(
        "home", "run", "hub", "sign", "channel"
    )


def _inferences(spark: SparkSession, folder: str) -> DataFrame:
    bins = ts_ops.label_bins(ts_ops.hub_bins(sensor_readings(spark, folder), HOUR))
    return readings_source.inference_view(bins)


def hub_selection(spark: SparkSession, folder: str) -> DataFrame:
    return readings_source.select_hub(_inferences(spark, folder), "RS2", "img")


def ffa_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Outer join of all hubs' audio, sentinel rows dropped, any-hub-positive prediction."""
    joined = factorial.outer_join_hubs(_inferences(spark, folder), "audio", HUBS)
    columns = [f"audio_{h[2:]}" for h in HUBS]
    kept = factorial.drop_sentinels(joined, [*columns, "occupied"])
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in columns[1:]),
                F.coalesce(F.col(columns[0]), F.lit(0)))
    return kept.select(
        "home", "day", "hr_min_sec", *columns, "occupied", (total > 0).cast("int").alias("pred")
    )


def _model_free(spark: SparkSession, folder: str, comparison: str = "img_audio"):
    return experiments.model_free_study(_inferences(spark, folder), comparison)


def ffa_daily_metrics(spark: SparkSession, folder: str) -> DataFrame:
    daily = _model_free(spark, folder).daily
    return rounded(daily, ["F1-Score", "Accuracy"])


def ffa_run_stats(spark: SparkSession, folder: str) -> DataFrame:
    table = _model_free(spark, folder, "audio_None").statistics
    return rounded(table, [c for c in table.columns if c not in ("home", "run")], 7)


def ffa_standard_error(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_model_free(spark, folder).errors(), factorial.DAILY_METRICS)


def sentinel_value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _model_free(spark, folder).sentinels()


def silent_value_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Value counts of a comparison whose run without channels sees the column ``null``."""
    return _model_free(spark, folder, "audio_None").sentinels()


def ffa_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_model_free(spark, folder).report(HUBS), factorial.DAILY_METRICS)


def look_ahead(spark: SparkSession, folder: str) -> DataFrame:
    samples = _inferences(spark, folder).select(
        "home", "hub", "day", F.substring("hr_min_sec", 1, 2).cast("int").alias("sample_no"),
        "audio", "img", "occupied",
    )
    return factorial.look_ahead(samples, ["audio", "img"], samples_per_day=24)


def _run_metrics(spark: SparkSession, folder: str, level: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Runs, hubs and a metric table per home and run: the OR predictor on each run's series."""
    spans, runs, series = experiments.factorial_series(
        sensor_readings(spark, folder), "img_audio", len(HUBS), HOUR, level
    )
    scored = predictors.or_baseline(series)
    counts = metrics.confusion(scored, ["home", "run"], prediction="pred_ai")
    return runs, spans.select("home", "hub"), stage(metrics.model_metrics(counts))


def _ffa_features(level: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        _, _, series = experiments.factorial_series(
            sensor_readings(spark, folder), "audio_None", len(HUBS), HOUR, level
        )
        return rounded(series.drop("pos"), CHANNELS)

    return run


def _main_effects(level: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        runs, hubs, table = _run_metrics(spark, folder, level)
        return rounded(effects.effects(effects.factors(runs, hubs), table), EFFECT_METRICS)

    return run


def _interaction_effects(level: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        runs, hubs, table = _run_metrics(spark, folder, level)
        found = effects.effects(effects.factors(runs, hubs, 2), table, count_baseline=False)
        return rounded(found, EFFECT_METRICS)

    return run


def _effects_table(level: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        runs, hubs, table = _run_metrics(spark, folder, level)
        return rounded(effects.effects_table(runs, hubs, table), EFFECT_METRICS)

    return run


# --- parameter grid of factorial studies --------------------------------------------------


GRID = ("audio_None", "img_audio", "img_None")


def _grid_rows(spark: SparkSession, folder: str) -> experiments.FactorialRows:
    """Three comparisons with and without environment; half designs."""
    source = sensor_readings(spark, folder)
    return experiments.factorial_rows(source, GRID, len(HUBS), HOUR, "half", (True, False))


def grid_features(spark: SparkSession, folder: str) -> DataFrame:
    """Series of every home, cell and run, from rows per set of active hubs."""
    rows = _grid_rows(spark, folder)
    return rounded(rows.expanded(rows.sets).drop("pos"), CHANNELS)


def grid_lags(spark: SparkSession, folder: str) -> DataFrame:
    """Lags of every set of active hubs: one table for all runs and cells that share them."""
    return _grid_rows(spark, folder).lagged().select("home", "active", "ts", "occupied", *LAGS)


def grid_effects(spark: SparkSession, folder: str) -> DataFrame:
    """Effects of hubs on the OR predictor with all channels, in every cell."""
    rows = _grid_rows(spark, folder)
    scored = predictors.or_baseline(rows.expanded(rows.sets))
    counts = metrics.confusion(scored, ["home", *experiments.RUN_KEYS], prediction="pred_aie")
    table = stage(metrics.model_metrics(counts))
    grid = experiments.FactorialGrid(rows.spans.select("home", "hub"), rows.runs, table)
    return rounded(grid.effects(), EFFECT_METRICS)


def hub_sign_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Hub columns of a result table, found by their names, as rows beside a metric."""
    runs, hubs, table = _run_metrics(spark, folder, "half")
    signs = designs.hub_columns(designs.long_design(runs, hubs), HUBS)
    wide = signs.join(table, ["home", "run"])
    found, _ = effects.split_columns(wide)
    long = wide.unpivot(["home", "run", "F1"], found, "hub", "sign")
    return rounded(long.where(F.col("sign").isNotNull()), ["F1"])


# --- configuration, records and files -----------------------------------------------------


def configured_hubs(spark: SparkSession, folder: str) -> DataFrame:
    """Hubs with readings that the configuration lists, with their thresholds."""
    listed = config.home_hubs(config.home_config(spark))
    seen = sensor_readings(spark, folder).select("home", "hub").distinct()
    return seen.join(listed, ["home", "hub"])


def configured_days(spark: SparkSession, folder: str) -> DataFrame:
    """Days of the ranges that the hubs of every home cover, overlapping ones once."""
    spans = ts_ops.hub_spans(sensor_readings(spark, folder), HOUR)
    ranges = F.collect_list(F.struct(F.to_date("first_ts").alias("start"), F.to_date("last_ts").alias("end")))
    return config.range_days(spans.groupBy("home").agg(ranges.alias("ranges")))


def date_ranges_file(spark: SparkSession, folder: str) -> DataFrame:
    """Each home's first and last day, written as a JSON file of date ranges and read back."""
    days = sensor_readings(spark, folder).groupBy("home").agg(
        F.min(F.to_date("ts")).cast("string").alias("a"), F.max(F.to_date("ts")).cast("string").alias("z"))
    entry = F.struct("home", F.array(F.array("a", "z")))
    path = new_folder(spark)
    days.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")).coalesce(1).write.text(path)
    return config.read_date_ranges(spark, path)


def results_read_back(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics per home, written as CSV and read back."""
    found = metrics_by_home(spark, folder)
    path = new_folder(spark)
    sinks.write_csv(found, path)
    return sinks.read_results_csv(spark, path, found.schema)


def coefficients_read_back(spark: SparkSession, folder: str) -> DataFrame:
    """A coefficient-like table with a column per home, written as CSV and read back as rows."""
    wide = reports.coefficients_by_home(_channel_means(spark, folder, "test"), HOMES)
    path = new_folder(spark)
    sinks.write_csv(wide.select("term", *HOMES), path)
    return rounded(sinks.read_coefficients_csv(spark, path, HOMES), ["value"])


def run_record(spark: SparkSession, folder: str) -> DataFrame:
    """The run parameters as flat text, written as JSON and read back."""
    record = run_params(spark, folder)
    path = new_folder(spark)
    sinks.write_run_parameters(record, path)
    back = spark.read.schema(record.schema).json(path)
    return back.select("home", F.array_join("hubs", ",").alias("hubs"), "fill",
                       F.to_json("params").alias("params"), F.col("cv").cast("int").alias("cv"), "best_c")


# --- coefficient reports ----------------------------------------------------------------


def _channel_means(spark: SparkSession, folder: str, role: str) -> DataFrame:
    """Mean of every channel per home as a long table shaped like coefficients."""
    rows = _with_roles(spark, folder).where(F.col("role") == role)
    wide = rows.groupBy("home").agg(*[F.avg(c).alias(c) for c in CHANNELS])
    return wide.withColumnRenamed("home", "train_home").unpivot(
        "train_home", list(CHANNELS), "term", "value"
    )


SUMMARY = ("mean", "med", "min", "max", "lbMed", "ubMed", "lbMean", "ubMean", "stdev", "errors")


def coeff_summary(spark: SparkSession, folder: str) -> DataFrame:
    table = reports.coefficient_summary(_channel_means(spark, folder, "train"), ["H4"])
    return rounded(table, SUMMARY, 7)


def coeff_summary_compat(spark: SparkSession, folder: str) -> DataFrame:
    means = stage(_channel_means(spark, folder, "train"))
    return rounded(reports.coefficient_summary(means, ["H4"], compat=True), SUMMARY, 7)


def coeff_join(spark: SparkSession, folder: str) -> DataFrame:
    first = reports.coefficient_summary(_channel_means(spark, folder, "train"))
    second = reports.coefficient_summary(_channel_means(spark, folder, "test"))
    joined = reports.join_cv_summary(first, second)
    return rounded(joined, [c for c in joined.columns if c != "term"], 7)


def coeff_order(spark: SparkSession, folder: str) -> DataFrame:
    table = reports.coefficients_by_home(_channel_means(spark, folder, "train"), HOMES)
    return reports.term_order(rounded(table, HOMES))


def sig_labels(spark: SparkSession, folder: str) -> DataFrame:
    means = _channel_means(spark, folder, "test")
    return means.select("train_home", "term", sig_str(F.round("value", DIGITS), 2).alias("text"))


# --- models and experiments -------------------------------------------------------------


def _trained(spark: SparkSession, folder: str, settings: TrainConfig):
    ready = _prepared(spark, folder)
    train_days = (
        _split_days(ready.spans)
        .where(F.col("role") == "train")
        .withColumn("dataset", F.col("home"))
    )
    return ready, experiments.train(stage(ready.features), train_days, settings)


def lr_l1(spark: SparkSession, folder: str) -> DataFrame:
    _, trained = _trained(spark, folder, TrainConfig())
    return rounded(models.coefficient_rows(trained.models), ["value"], 6)


def lr_l1_cv(spark: SparkSession, folder: str) -> DataFrame:
    _, trained = _trained(spark, folder, TrainConfig(cv=True))
    return rounded(models.coefficient_rows(trained.models, cv=True), ["value"], 6)


def lr_coeff_report(spark: SparkSession, folder: str) -> DataFrame:
    _, trained = _trained(spark, folder, TrainConfig())
    table = reports.coefficients_by_home(models.coefficient_rows(trained.models), HOMES)
    return reports.term_order(rounded(table, HOMES, 6))


def _optimality(cv: bool) -> Query:
    """Training rows of every home, and whether its model is optimal for one of the candidate strengths."""
    def query(spark: SparkSession, folder: str) -> DataFrame:
        settings = TrainConfig(cv=cv)
        ready, trained = _trained(spark, folder, settings)
        days = _split_days(ready.spans).where(F.col("role") == "train").select("home", "day")
        rows = models.training_rows(ready.features.join(days, ["home", "day"]), "home")
        found = models.optimality(rows, trained.models)
        allowed = models.candidate_strengths(settings.n_candidates) if cv else [settings.c]
        listed = F.array_contains(F.array(*[F.lit(c) for c in allowed]), F.col("c"))
        return found.select(F.col("dataset").alias("home"), "n_rows", "n_occupied",
                            (F.col("breach") < 1e-4).cast("int").alias("optimal"), listed.cast("int").alias("strength_listed"))

    return query


def run_params(spark: SparkSession, folder: str) -> DataFrame:
    settings = TrainConfig()
    ready, trained = _trained(spark, folder, settings)
    return sinks.run_parameters(ready.spans.select("home", "hub"), trained.models, settings)


def five_predictors(spark: SparkSession, folder: str) -> DataFrame:
    _, _, predictions = experiments.cross_home(sensor_readings(spark, folder), HOMES, HOUR)
    return rounded(predictions, [c for c in predictions.columns if c.startswith("prob")], 6)


def cross_home(spark: SparkSession, folder: str) -> DataFrame:
    return experiments.cross_home(sensor_readings(spark, folder), HOMES, HOUR)[0]


def split_sweep(spark: SparkSession, folder: str) -> DataFrame:
    homes = [h for h in HOMES if h != "H4"]
    return experiments.split_sweep(sensor_readings(spark, folder), homes, HOUR)


def _ffa_experiment(level: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return experiments.factorial_experiment(
            sensor_readings(spark, folder), "audio_None", len(HUBS), HOUR, level
        ).table(HUBS)

    return run


def _ffa_experiment_effects(level: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return experiments.factorial_experiment(
            sensor_readings(spark, folder), "img_audio", len(HUBS), HOUR, level
        ).effects()

    return run


QUERIES: dict[str, Query] = {
    "resample_5min": resample_5min,
    "channel_subset": channel_subset,
    "gapfill_zeros": _filled("zeros", HOUR),
    "gapfill_ones": _filled("ones", HOUR),
    "gapfill_ffill": _filled("ffill", HOUR),
    "hub_fusion": hub_fusion,
    "calendar_features": calendar_features,
    "static_lags": _lags(rolling=False),
    "rolling_lags": _lags(rolling=True),
    "model_features": model_features,
    "environment_dropped": environment_dropped,
    "day_split": day_split,
    "split_sweep_days": split_sweep_days,
    "train_day_rows": train_day_rows,
    "day_intersection": day_intersection,
    "awake_samples": awake_samples,
    "or_baseline": or_baseline,
    "nonparametric_model": nonparametric_model,
    "nonparametric_pred": nonparametric_pred,
    "score_true_lags": score_true_lags,
    "predictor_metrics": predictor_metrics,
    "rollout": rollout,
    "example_predictions": example_predictions,
    "example_cross_home": example_cross_home,
    "metrics_by_home": metrics_by_home,
    "metrics_sigdigits": metrics_sigdigits,
    "confusion_table": confusion_table,
    "cross_home_nonparametric": cross_home_nonparametric,
    "split_direction_nonparametric": split_direction_nonparametric,
    "pivot_train_test": pivot_train_test,
    "f1_pair_pivot": f1_pair_pivot,
    "daily_occupancy": daily_occupancy,
    "relabel_hubs": relabel_hubs,
    "label_diff_wide": label_diff_wide,
    "distinct_hubs": distinct_hubs,
    "design_full": _design("full"),
    "design_half": _design("half"),
    "hub_modalities": hub_modalities,
    "hub_selection": hub_selection,
    "ffa_predictions": ffa_predictions,
    "ffa_daily_metrics": ffa_daily_metrics,
    "ffa_run_stats": ffa_run_stats,
    "ffa_standard_error": ffa_standard_error,
    "sentinel_value_counts": sentinel_value_counts,
    "silent_value_counts": silent_value_counts,
    "ffa_report": ffa_report,
    "look_ahead": look_ahead,
    "ffa_features": _ffa_features("half"),
    "ffa_features_full": _ffa_features("full"),
    "main_effects": _main_effects("half"),
    "main_effects_full": _main_effects("full"),
    "interaction_effects": _interaction_effects("half"),
    "interaction_effects_full": _interaction_effects("full"),
    "effects_table": _effects_table("half"),
    "effects_table_full": _effects_table("full"),
    "grid_features": grid_features,
    "grid_lags": grid_lags,
    "grid_effects": grid_effects,
    "hub_sign_rows": hub_sign_rows,
    "configured_hubs": configured_hubs,
    "configured_days": configured_days,
    "date_ranges_file": date_ranges_file,
    "results_read_back": results_read_back,
    "coefficients_read_back": coefficients_read_back,
    "run_record": run_record,
    "coeff_summary": coeff_summary,
    "coeff_summary_compat": coeff_summary_compat,
    "coeff_join": coeff_join,
    "coeff_order": coeff_order,
    "sig_labels": sig_labels,
    "lr_l1": lr_l1,
    "lr_l1_cv": lr_l1_cv,
    "lr_coeff_report": lr_coeff_report,
    "lr_optimality": _optimality(cv=False),
    "lr_cv_optimality": _optimality(cv=True),
    "run_params": run_params,
    "five_predictors": five_predictors,
    "cross_home": cross_home,
    "split_sweep": split_sweep,
    "ffa_experiment": _ffa_experiment("full"),
    "ffa_experiment_half": _ffa_experiment("half"),
    "ffa_experiment_effects": _ffa_experiment_effects("full"),
    "ffa_experiment_effects_half": _ffa_experiment_effects("half"),
}
