"""Train/test experiments: cross-home matrix, split sweep and factorial studies.

An experiment is a list of training sets and test series over days of homes.  Rows meet
that list on (home, day), a key no home can dominate, and every model of an experiment is
fitted in one batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomtide.functions.numeric import at_least
from roomtide.operators import design as designs
from roomtide.operators import factorial, models, predictors
from roomtide.operators import timeseries as ts_ops
from roomtide.operators.effects import effects_table
from roomtide.operators.metrics import COUNTS, confusion_of_predictors, model_metrics
from roomtide.operators.reports import cross_home_order, split_order
from roomtide.operators.splits import (
    assign_split,
    days_of_spans,
    keep_days,
    with_directions,
)
from roomtide.plans.features import complete_rows, filled_bins, prepare
from roomtide.runtime import spread, stage
from roomtide.schemas import LAGS
from roomtide.sources.config import TrainConfig, ordered_days

# Report names of the predictors and their prediction columns.
PREDICTORS = {
    "OR (ai)": "pred_ai",
    "OR (aie)": "pred_aie",
    "Nonparametric": "pred_np",
    "ground truth AR": "pred_gt",
    "AR predictions (aie)": "pred_ar",
}
ROLLOUT_ONLY = {"AR predictions (aie)": "pred_ar"}
# Split ratios of the sweep.
SWEEP = (0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)


@dataclass(frozen=True)
class Trained:
    """Regression models and time-of-day lookups per training set."""

    models: DataFrame
    lookup: DataFrame


def joined_id(*parts: str | Column) -> Column:
    """The parts joined by ``|``; a ``|`` or backslash inside a part gets a backslash before it."""
    return F.concat_ws("|", *[
        F.regexp_replace(F.col(p) if isinstance(p, str) else p, r"([|\\])", r"\\$1") for p in parts])


def id_parts(joined: str, n: int = 2) -> list[Column]:
    """The first ``n`` parts of an id that :func:`joined_id` made."""
    found = F.regexp_extract_all(F.col(joined), F.lit(r"((?:[^|\\]|\\.)*)(?:\||$)"), F.lit(1))
    return [F.regexp_replace(found[k], r"\\(.)", "$1") for k in range(n)]


def train(
    features: DataFrame,
    train_days: DataFrame,
    config: TrainConfig = TrainConfig(),
    unit: Sequence[str] = ("home",),
) -> Trained:
    """Fit every training set; ``train_days`` lists unit, day and ``dataset``.

    ``features`` should be staged.
    """
    labelled = spread(
        features.join(train_days.select(*unit, "day", "dataset"), [*unit, "day"]),
        "dataset",
        "day",
    )
    if config.cv:
        complete = stage(complete_rows(labelled))
        folded = models.assign_folds(complete, ["dataset"], config.n_folds)
        rows = stage(models.training_rows(spread(folded, "dataset", "day"), fold="fold"))
    else:
        rows = stage(models.training_rows(labelled))
    names = train_days.select("dataset").distinct()
    fitted = (
        models.fit_l1_cv(rows, names, config.n_candidates, config.n_folds, max_passes=config.max_iter)
        if config.cv
        else models.fit_l1(
            rows,
            names.select("dataset", F.lit(config.c).alias("c"), F.lit(models.NO_HOLDOUT).alias("holdout")),
            max_passes=config.max_iter,
        )
    )
    lookup = predictors.time_of_day_model(labelled, ["dataset"])
    return Trained(fitted, lookup)


def series_rows(
    features: DataFrame,
    tests: DataFrame,
    fitted: DataFrame,
    unit: Sequence[str] = ("home",),
) -> DataFrame:
    """Rows of every test series with its model's ``coef`` and its ``series_pos``.

    ``tests`` lists ``series_id``, ``dataset`` (the model), unit and day.  Positions come
    from per-day row counts, so no series is ever sorted as a whole here.  Rows without all
    lags have no position: the regressions cannot score them, the other predictors do.
    A test series whose model is missing is an error.
    """
    wanted = tests.select("dataset").distinct()
    if not wanted.join(fitted.select("dataset"), "dataset", "left_anti").isEmpty():
        raise ValueError("a test series asks for a model that has no training rows")
    complete = complete_rows(features)
    places = complete.groupBy(*unit, "day").agg(
        F.min("pos").alias("first_pos"), F.count("*").alias("n_rows")
    )
    earlier = (
        Window.partitionBy("series_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    )
    listed = stage(tests.join(places, [*unit, "day"], "left"))
    lengths = listed.groupBy("series_id").agg(F.sum("n_rows").alias("n"))
    tasks = int(features.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schedule = (
        listed.withColumn("offset", F.coalesce(F.sum("n_rows").over(earlier), F.lit(0)))
        .join(fitted.select("dataset", "coef"), "dataset")
        .join(predictors.place_series(lengths, tasks), "series_id")
        .select("series_id", "dataset", *unit, "day", "first_pos", "offset", "coef", "task", "slot")
    )
    known = reduce(and_, [F.col(c).isNotNull() for c in LAGS])
    place = F.col("offset") + F.col("pos") - F.col("first_pos")
    return features.join(stage(schedule), [*unit, "day"]).withColumn("series_pos", F.when(known, place))


def predict_instant(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Every predictor but the rollout, side by side."""
    scored = predictors.score_true_lags(predictors.or_baseline(rows))
    return predictors.time_of_day_predict(scored, lookup, ["dataset"])


def predict_rollout(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The regression fed with its own predictions; only needed columns reach Python."""
    ready = predictors.rollout_input(rows.where(F.col("series_pos").isNotNull()))
    return predictors.rollout(
        ready.select("series_id", "series_pos", "ts", "occupied", *keep, "base", "lag_weights", "task", "slot")
    )


def predict_all(rows: DataFrame, trained: Trained) -> DataFrame:
    """Probabilities and classes of all five predictors per test row."""
    instant = predict_instant(rows, trained.lookup)
    kept = [f"{kind}_{name}" for name in ("ai", "aie", "np", "gt") for kind in ("prob", "pred")]
    rolled = predict_rollout(instant, kept)
    # Rows without all lags: the regressions have no opinion, and metrics leave NULL out.
    rest = instant.where(F.col("series_pos").isNull()).select("series_id", "series_pos", "ts", "occupied", *kept)
    return rolled.unionByName(rest, allowMissingColumns=True)


def split_cells(features: DataFrame, days: DataFrame, splits: Sequence[float]) -> DataFrame:
    """train_0, train_1, test_0, test_1 per home, split, direction, weekend flag and time of day.

    One aggregation counts each cell up to every split's last training day; training and test
    counts of both directions follow by subtraction, and no row meets more than one day.
    """
    numbered = features.select("home", "day", "weekend", "tod_min", "occupied").join(
        ordered_days(days).select("home", "day", "day_no", "n_days"), ["home", "day"])

    def until(ratio: float, y: int) -> Column:
        early = F.col("day_no") <= F.floor(F.col("n_days") * F.lit(float(ratio)))
        return F.count_if(early & (F.col("occupied") == y))

    sums = [until(s, y).alias(f"c{k}_{y}") for k, s in enumerate(splits) for y in (0, 1)]
    total = [F.count_if(F.col("occupied") == y).alias(f"all_{y}") for y in (0, 1)]
    cells = numbered.groupBy("home", "weekend", "tod_min").agg(*total, *sums)

    def counts(k: int, direction: str) -> Column:
        early = [F.col(f"c{k}_{y}") for y in (0, 1)]
        late = [F.col(f"all_{y}") - F.col(f"c{k}_{y}") for y in (0, 1)]
        train, test = (early, late) if direction == "normal" else (late, early)
        return F.struct(
            F.lit(float(splits[k])).alias("split"), F.lit(direction).alias("direction"),
            *[c.alias(f"{role}_{y}") for role, both in (("train", train), ("test", test)) for y, c in enumerate(both)])

    ways = F.array(*[counts(k, d) for k in range(len(splits)) for d in ("normal", "reverse")])
    return cells.select("home", "weekend", "tod_min", F.explode(ways).alias("w")).select(
        "home", "weekend", "tod_min", "w.*")


def role_cells(features: DataFrame, roles: DataFrame) -> DataFrame:
    """train_0, train_1, test_0, test_1 per home, weekend flag and time of day."""
    placed = features.select("home", "day", "weekend", "tod_min", "occupied").join(
        roles.select("home", "day", "role"), ["home", "day"])
    return placed.groupBy("home", "weekend", "tod_min").agg(
        *[F.count_if((F.col("role") == role) & (F.col("occupied") == y)).alias(f"{role}_{y}")
          for role in ("train", "test") for y in (0, 1)])


def or_counts(features: DataFrame, tests: DataFrame) -> DataFrame:
    """Confusion counts of the OR predictors per ``series_id``: rows are counted once per home and
    day, and the days of a series added up."""
    scored = predictors.or_baseline(features)
    names = {k: v for k, v in PREDICTORS.items() if k.startswith("OR")}
    days = confusion_of_predictors(scored, ["home", "day"], names)
    return tests.select("series_id", "home", "day").join(days, ["home", "day"]).groupBy("series_id", "function").agg(
        *[F.sum(c).alias(c) for c in COUNTS])


def regression_counts(rows: DataFrame) -> DataFrame:
    """Confusion counts of the regressions per ``series_id``; the only predictors whose rows are
    repeated for every model."""
    names = {k: v for k, v in PREDICTORS.items() if v in ("pred_gt", "pred_ar")}
    return confusion_of_predictors(predict_rollout(predictors.score_true_lags(rows), ["pred_gt"]), ["series_id"], names)


def experiment_metrics(predictions: DataFrame, names: dict[str, str] = PREDICTORS) -> DataFrame:
    return model_metrics(confusion_of_predictors(predictions, ["series_id"], names))


def _with_labels(metrics: DataFrame, labels: DataFrame) -> DataFrame:
    return metrics.join(labels, "series_id").drop("series_id")


def cross_home_tests(roles: DataFrame, homes: Sequence[str]) -> DataFrame:
    """Test days of every requested (train, test) pair of homes."""
    pairs = roles.sparkSession.createDataFrame(
        [(a, b) for a in homes for b in homes], "train STRING, home STRING"
    )
    return (
        roles.where(F.col("role") == "test")
        .join(pairs, "home")
        .select(
            joined_id("train", "home").alias("series_id"),
            F.col("train").alias("dataset"),
            "home",
            "day",
        )
    )


def _pair_labels(metrics: DataFrame) -> DataFrame:
    train_home, test_home = id_parts("series_id")
    return metrics.select(
        *[c for c in metrics.columns if c != "series_id"],
        train_home.alias("train"),
        test_home.alias("test"),
        F.when(train_home == test_home, "self").otherwise("cross").alias("self/cross"),
    )


def cross_home(
    readings: DataFrame,
    homes: Sequence[str],
    bin_minutes: int = 5,
    config: TrainConfig = TrainConfig(),
    split: float = 0.6,
    days: DataFrame | None = None,
) -> tuple[DataFrame, Trained, DataFrame]:
    """Train on every home, test on every home: (metrics, models, predictions)."""
    ready = prepare(readings, bin_minutes, config.fill)
    features = stage(ready.features)
    listed = days_of_spans(ready.spans) if days is None else days
    roles = assign_split(listed, [split]).where(F.col("home").isin(*homes))
    train_days = roles.where(F.col("role") == "train").withColumn("dataset", F.col("home"))
    trained = train(features, train_days, config)
    tests = stage(cross_home_tests(roles, homes))
    rows = series_rows(features, tests, trained.models)
    lookups = lookup_matrix(stage(role_cells(features, roles)), homes).select(
        "train", "test", "self/cross", F.lit("Nonparametric").alias("function"), *COUNTS)
    counts = or_counts(features, tests).unionByName(
        regression_counts(rows.where(F.col("series_pos").isNotNull())))
    metrics = model_metrics(_pair_labels(counts).unionByName(lookups))
    return cross_home_order(metrics), trained, predict_all(rows, trained)


def split_sweep(
    readings: DataFrame,
    homes: Sequence[str],
    bin_minutes: int = 5,
    splits: Sequence[float] = SWEEP,
    config: TrainConfig = TrainConfig(),
    days: DataFrame | None = None,
) -> DataFrame:
    """Metrics of every home, split ratio and direction."""
    ready = prepare(readings, bin_minutes, config.fill)
    features = stage(ready.features)
    listed = days_of_spans(ready.spans) if days is None else days
    roles = (
        with_directions(assign_split(listed.where(F.col("home").isin(*homes)), splits))
        .withColumn("dataset", joined_id("home", F.col("split").cast("string"), "direction"))
        .withColumn("series_id", F.col("dataset"))
    )
    trained = train(features, roles.where(F.col("role") == "train"), config)
    tests = roles.where(F.col("role") == "test")
    rows = series_rows(complete_rows(features), tests, trained.models)
    keys = ("split", "home", "direction")
    labels = roles.select("series_id", *keys).distinct()
    counts = or_counts(features, tests).unionByName(regression_counts(rows))
    tested = tests.select(*keys).distinct()
    used = listed.where(F.col("home").isin(*homes))
    lookups = lookup_counts(split_cells(features, used, splits), keys).join(tested, [*keys], "left_semi")
    both = _with_labels(counts, labels).unionByName(lookups.withColumn("function", F.lit("Nonparametric")))
    return split_order(model_metrics(both))


@dataclass(frozen=True)
class FactorialResult:
    """Runs with signs, metrics and coefficients per home and run."""

    hubs: DataFrame
    runs: DataFrame
    metrics: DataFrame
    models: DataFrame

    def table(self, hub_names: Sequence[str]) -> DataFrame:
        """Metrics per run with the run's sign of every hub."""
        signs = designs.hub_columns(designs.long_design(self.runs, self.hubs), hub_names)
        return signs.join(self.metrics, ["home", "run"])

    def coefficients(self) -> DataFrame:
        """Coefficients per home and run as long rows."""
        parts = id_parts("train_home", 4)
        return models.coefficient_rows(self.models).select(
            parts[0].alias("home"), parts[3].cast("int").alias("run"), "term", "value"
        )

    def effects(self) -> DataFrame:
        """Baseline, average, main effects and two-hub interactions of every metric."""
        return effects_table(self.runs, self.hubs, self.metrics)


RUN_KEYS = ("comparison", "environment", "run")


@dataclass(frozen=True)
class FactorialRows:
    """Hub spans, runs with their cells, and rows per set of active hubs."""

    spans: DataFrame
    runs: DataFrame
    sets: DataFrame
    n_hubs: int

    def lagged(self) -> DataFrame:
        """Set rows with lags and calendar columns: computed once for all runs of a set."""
        reach = ts_ops.N_LAGS * ts_ops.ROWS_PER_LAG
        rows = ts_ops.lag_columns(ts_ops.with_halo(self.sets, reach), ("home", "active"))
        return predictors.with_time_of_day(ts_ops.calendar_features(ts_ops.drop_halo(rows)))

    def expanded(self, rows: DataFrame, keys: Sequence[str] = RUN_KEYS) -> DataFrame:
        return factorial.expand_runs(rows, self.runs, self.n_hubs, keys)


def factorial_rows(
    readings: DataFrame,
    comparisons: Sequence[str],
    n_hubs: int,
    bin_minutes: int = 5,
    level: str = "full",
    environments: Sequence[bool] = (True,),
    fill: str = "zeros",
    baseline: bool = True,
) -> FactorialRows:
    """What the runs of a parameter grid share."""
    spans = stage(ts_ops.hub_spans(readings, bin_minutes))
    runs = designs.design(spans.select("home", "hub"), level)
    if baseline:
        runs = factorial.with_baseline(runs)
    runs = stage(factorial.with_cells(runs, comparisons, environments))
    wide = factorial.hubs_side_by_side(filled_bins(readings, bin_minutes, fill, spans), n_hubs)
    sets = factorial.set_series(wide, factorial.set_segments(runs, spans, bin_minutes), n_hubs, bin_minutes)
    return FactorialRows(spans, runs, sets, n_hubs)


def factorial_series(
    readings: DataFrame,
    comparison: str,
    n_hubs: int,
    bin_minutes: int = 5,
    level: str = "full",
    environment: bool = True,
    fill: str = "zeros",
    baseline: bool = True,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(spans, runs, fused series per run) of a factorial study with one comparison."""
    rows = factorial_rows(readings, [comparison], n_hubs, bin_minutes, level, [environment], fill, baseline)
    runs = rows.runs.select("home", "n_hubs", "run", "signs")
    return rows.spans, runs, rows.expanded(rows.sets, ("run",))


@dataclass(frozen=True)
class FactorialGrid:
    """Results of all cells: metrics per home, comparison, environment and run."""

    hubs: DataFrame
    runs: DataFrame
    metrics: DataFrame
    models: DataFrame | None = None

    def _cell(self, comparison: str, environment: bool) -> tuple[DataFrame, DataFrame]:
        """Runs and metrics of one cell."""
        here = (F.col("comparison") == comparison) & (F.col("environment") == environment)
        runs = self.runs.where(here).select("home", "n_hubs", "run", "signs")
        return runs, self.metrics.where(here).drop("comparison", "environment")

    def cell(self, comparison: str, environment: bool = True) -> FactorialResult:
        of_cell = id_parts("dataset", 3)
        own = (of_cell[1] == comparison) & (of_cell[2] == str(environment).lower())
        runs, metrics = self._cell(comparison, environment)
        return FactorialResult(self.hubs, runs, metrics, self.models.where(own))

    def effects(self) -> DataFrame:
        """The effects table of every cell, one below the other."""
        cells = [(r.comparison, r.environment) for r in
                 self.runs.select("comparison", "environment").distinct().collect()]  # the grid asked for
        tables = [
            effects_table(runs, self.hubs, metrics).select(
                F.lit(c).alias("comparison"), F.lit(e).alias("environment"), "*")
            for c, e in sorted(cells)
            for runs, metrics in [self._cell(c, e)]
        ]
        return reduce(DataFrame.unionByName, tables)


def factorial_grid(
    readings: DataFrame,
    comparisons: Sequence[str],
    environments: Sequence[bool] = (True, False),
    n_hubs: int = 5,
    bin_minutes: int = 5,
    level: str = "full",
    split: float = 0.6,
    config: TrainConfig = TrainConfig(),
    days: DataFrame | None = None,
) -> FactorialGrid:
    """Fit and roll out one model per home, cell and run, baseline run 0 included, as one job.

    Cells differ in column expressions only: lags, labels and environment are made once per
    set of active hubs, all models are fitted together and all series rolled out together.
    """
    made = factorial_rows(readings, comparisons, n_hubs, bin_minutes, level, environments, config.fill)
    features = stage(made.expanded(made.lagged()))
    listed = days_of_spans(made.spans) if days is None else days
    unit = ("home", *RUN_KEYS)
    roles = (
        assign_split(listed, [split])
        .join(made.runs.select(*unit), "home")
        .withColumn("dataset", joined_id(*[F.col(k).cast("string") for k in unit]))
        .withColumn("series_id", F.col("dataset"))
    )
    trained = train(features, roles.where(F.col("role") == "train"), config, unit)
    rows = series_rows(features, roles.where(F.col("role") == "test"), trained.models, unit)
    counted = experiment_metrics(predict_rollout(rows), ROLLOUT_ONLY)
    labels = roles.select("series_id", *unit).distinct()
    metrics = _with_labels(counted, labels)
    return FactorialGrid(made.spans.select("home", "hub"), made.runs, stage(metrics), trained.models)


def factorial_experiment(
    readings: DataFrame,
    comparison: str = "audio_None",
    n_hubs: int = 5,
    bin_minutes: int = 5,
    level: str = "full",
    environment: bool = True,
    split: float = 0.6,
    config: TrainConfig = TrainConfig(),
    days: DataFrame | None = None,
) -> FactorialResult:
    """One cell of :func:`factorial_grid`."""
    grid = factorial_grid(
        readings, [comparison], [environment], n_hubs, bin_minutes, level, split, config, days
    )
    return grid.cell(comparison, environment)


@dataclass(frozen=True)
class ModelFreeStudy:
    """Any-hub-positive predictor of every run, scored per day.

    ``states`` are the counted hub states; ``days`` restricts the scored days.
    """

    states: DataFrame
    hubs: DataFrame
    runs: DataFrame
    comparison: str
    days: DataFrame | None = None

    @cached_property
    def seen(self) -> DataFrame:
        return factorial.runs_on_states(self.states, self.runs, self.hubs, self.comparison)

    def sentinels(self) -> DataFrame:
        """Value counts before and after sentinel rows are dropped."""
        return factorial.sentinel_counts(self.seen)

    @cached_property
    def daily(self) -> DataFrame:
        """Metrics per home, run and day; every listed day counts, also one without rows."""
        predictions = factorial.model_free_predictions(self.seen)
        if self.days is not None:
            predictions = keep_days(predictions, self.days)
        return factorial.daily_metrics(
            factorial.with_empty_days(predictions, self.runs, self._scored_days)
        )

    @property
    def _scored_days(self) -> DataFrame:
        days = self.states if self.days is None else self.days
        return days.select("home", "day").distinct()

    @cached_property
    def statistics(self) -> DataFrame:
        """Mean and variance of the daily metrics per run."""
        return factorial.run_statistics(self.daily)

    def errors(self) -> DataFrame:
        """Standard error of every metric per home."""
        return factorial.standard_error(self.statistics, self._scored_days)

    def report(self, hub_names: Sequence[str]) -> DataFrame:
        """A row per run with signs and metrics, and a standard error row per home."""
        long_runs = designs.assign_channels(
            designs.long_design(self.runs, self.hubs), self.comparison
        )
        return factorial.experiment_report(
            self.statistics, self.errors(), long_runs, hub_names
        )


def model_free_study(
    inferences: DataFrame,
    comparison: str,
    level: str = "full",
    days: DataFrame | None = None,
) -> ModelFreeStudy:
    states = stage(factorial.hub_states(inferences))
    hubs = factorial.hubs_of_states(states)
    return ModelFreeStudy(states, hubs, designs.design(hubs, level), comparison, days)


def lookup_matrix(cells: DataFrame, homes: Sequence[str]) -> DataFrame:
    """Cross-home confusion counts of the lookup predictor from time-of-day cells.

    Test rows are counted per cell before any training home looks at them.  Only cells a
    model calls occupied are joined; what remains of a test home is predicted vacant.
    """
    train_rows = F.col("train_0") + F.col("train_1")
    occupied = (
        cells.where(at_least(F.col("train_1") / train_rows) == 1)
        .where(train_rows > 0)
        .select(F.col("home").alias("train"), "weekend", "tod_min")
    )
    pairs = cells.sparkSession.createDataFrame(
        [(a, b) for a in homes for b in homes], "train STRING, test STRING"
    )
    totals = cells.groupBy(F.col("home").alias("test")).agg(
        F.sum("test_0").alias("n0"), F.sum("test_1").alias("n1")
    )
    tests = cells.select(F.col("home").alias("test"), "weekend", "tod_min", "test_0", "test_1")
    hits = (
        occupied.join(pairs, "train")
        .join(tests, ["test", "weekend", "tod_min"])
        .groupBy("train", "test")
        .agg(F.sum("test_0").alias("fp"), F.sum("test_1").alias("tp"))
    )
    filled = pairs.join(totals, "test").join(hits, ["train", "test"], "left").fillna(0, ["fp", "tp"])
    return filled.select(
        "train",
        "test",
        F.when(F.col("train") == F.col("test"), "self").otherwise("cross").alias("self/cross"),
        (F.col("n0") - F.col("fp")).alias("tn"),
        "fp",
        (F.col("n1") - F.col("tp")).alias("fn"),
        "tp",
    )


def lookup_counts(cells: DataFrame, keys: Sequence[str] = ("home",)) -> DataFrame:
    """Confusion counts of the lookup predictor per key, straight from its cells."""
    probability = F.try_divide(F.col("train_1"), F.col("train_0") + F.col("train_1"))
    pred = at_least(probability)

    def total(column: str, wanted: int) -> Column:
        return F.sum(F.when(pred == wanted, F.col(column)).otherwise(0))

    return cells.groupBy(*keys).agg(
        total("test_0", 0).alias("tn"),
        total("test_0", 1).alias("fp"),
        total("test_1", 0).alias("fn"),
        total("test_1", 1).alias("tp"),
    )
