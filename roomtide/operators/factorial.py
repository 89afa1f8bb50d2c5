"""Factorial sensor experiments: features per run, and the model-free variant.

A run decides which channel every hub contributes.  Hubs are first brought side by side
once per home and time, then repeated for every set of active hubs, whose runs share label, lags and
environment; all runs of a set, over any grid of comparisons, are plain column expressions over
its rows (or over counted distinct rows), so readings are not joined or shuffled once per run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomtide.functions.numeric import ratio_or_zero, sig_round
from roomtide.operators import design as designs
from roomtide.operators.metrics import with_rates
from roomtide.operators.timeseries import place_in_segments, position_in
from roomtide.runtime import spread
from roomtide.schemas import CHANNELS, ENV, NO_CHANNEL

BASELINE_RUN = 0
# Fixed value: divisor of the reported standard error.
STANDARD_ERROR_DIVISOR = 10
DAILY_METRICS = ("FPR", "TPR", "FNR", "TNR", "F1-Score", "Accuracy")


def hubs_side_by_side(bins: DataFrame, n_hubs: int) -> DataFrame:
    """One row per home and bin with ``<column>_<hub_no>`` for every hub.

    ``bins`` are filled and labelled; hubs beyond ``n_hubs`` raise an error.
    """
    number = F.when(F.col("hub_no") <= n_hubs, F.col("hub_no")).otherwise(
        F.raise_error(F.lit(f"more than {n_hubs} hubs in a home")).cast("int")
    )
    wide = [
        F.expr(f"max(CASE WHEN hub_no = {j} THEN {c} END) AS {c}_{j}")
        for j in range(1, n_hubs + 1)
        for c in (*CHANNELS, "occupied")
    ]
    return bins.withColumn("hub_no", number).groupBy("home", "ts").agg(*wide)


def with_baseline(runs: DataFrame) -> DataFrame:
    """Add run 0 per home, in which every hub contributes all its channels."""
    zero = (
        runs.groupBy("home")
        .agg(F.max("n_hubs").alias("n_hubs"))
        .select(
            "home",
            "n_hubs",
            F.lit(BASELINE_RUN).alias("run"),
            F.expr("array_repeat(0, n_hubs)").alias("signs"),
        )
    )
    return runs.unionByName(zero)


def with_cells(
    runs: DataFrame, comparisons: Sequence[str], environments: Sequence[bool] = (True,)
) -> DataFrame:
    """Repeat every run for the cells of a parameter grid.

    Adds ``comparison``, ``environment``, the channels ``high`` and ``low`` that signs +1 and -1
    stand for, and ``active``: numbers of the hubs that contribute, joined by commas.  The first
    hub is always active, as carrier of zero-valued channels, environment and label.
    """
    cells = F.array(*[
        F.struct(F.lit(c).alias("comparison"), F.lit(e).alias("environment"),
                 *[F.lit(ch).alias(n) for n, ch in zip(("high", "low"), designs.split_comparison(c))])
        for c in comparisons for e in environments
    ])
    active = (
        "array_join(filter(transform(signs, (s, i) -> CASE WHEN i = 0 OR s = 0 "
        f"OR (s = 1 AND high <> '{NO_CHANNEL}') OR (s = -1 AND low <> '{NO_CHANNEL}') "
        "THEN i + 1 END), j -> j IS NOT NULL), ',')"
    )
    repeated = runs.withColumn("cell", F.explode(cells)).select(*runs.columns, "cell.*")
    return repeated.withColumn("active", F.expr(active))


def set_segments(runs: DataFrame, spans: DataFrame, bin_minutes: int) -> DataFrame:
    """Every home's sets of active hubs with their own time segments: the bins the hubs cover.

    A row per set; ``segments`` holds at most one entry per hub.
    """
    sets = runs.select("home", "active").distinct()
    hubs = sets.withColumn("hub_no", F.explode(F.split("active", ",").cast("array<int>"))).join(
        spans.select("home", "hub", "hub_no", "first_ts", "last_ts"), ["home", "hub_no"]
    )
    placed = place_in_segments(hubs, ["home", "active"], bin_minutes)
    return placed.groupBy("home", "active").agg(
        F.collect_set(F.struct("seg_start", "seg_end", "seg_offset")).alias("segments")
    )


def _per_day(sets: DataFrame) -> DataFrame:
    """Repeat each set for its segments and their days, as key for the rows of a home."""
    days = "explode(sequence(to_date(seg_start), to_date(seg_end), INTERVAL 1 DAY))"
    segments = sets.withColumn("segment", F.explode("segments")).drop("segments")
    per_day = segments.select("*", "segment.*").drop("segment").withColumn("day", F.expr(days))
    return spread(per_day, "home", "day")


def set_series(wide: DataFrame, sets: DataFrame, n_hubs: int, bin_minutes: int) -> DataFrame:
    """Series of every set of active hubs: environment, label and position ``pos``, fused over its
    hubs, beside each hub's audio and image.

    All that runs of a set share, and so do their lags, is made once per set; see
    :func:`expand_runs`.
    """
    numbers = range(1, n_hubs + 1)
    flags = [F.array_contains(F.split("active", ","), str(j)).alias(f"on_{j}") for j in numbers]

    def fused(column: str) -> str:
        terms = [f"CASE WHEN on_{j} THEN {column}_{j} END" for j in numbers]
        return f"greatest({', '.join(terms)}, NULL)"

    schedule = _per_day(sets.select("home", "active", "segments", *flags))
    return (
        wide.withColumn("day", F.to_date("ts"))
        .join(schedule, ["home", "day"])
        .where("ts BETWEEN seg_start AND seg_end")
        .select(
            "home",
            "active",
            "ts",
            *[f"{c}_{j}" for c in ("audio", "img") for j in numbers],
            *[F.expr(f"coalesce({fused(c)}, 0D) AS {c}") for c in ENV],
            F.expr(f"cast({fused('occupied')} AS INT) AS occupied"),
            position_in("", bin_minutes).alias("pos"),
        )
    )


def expand_runs(rows: DataFrame, runs: DataFrame, n_hubs: int, keys: Sequence[str] = ("run",)) -> DataFrame:
    """Rows of every run from those of its set of active hubs: column expressions, driven by the
    run's signs and cell.

    A channel the comparison does not use, and the environment when switched off, is the
    constant 0, which leaves its model weight at 0 just as dropping the column would.
    """
    numbers = range(1, n_hubs + 1)

    def channel(name: str) -> Column:
        def on(j: int) -> str:
            sign = f"get(signs, {j - 1})"
            return f"({sign} = 0 OR ({sign} = 1 AND high = '{name}') OR ({sign} = -1 AND low = '{name}'))"

        terms = [f"CASE WHEN {on(j)} THEN {name}_{j} END" for j in numbers]
        return F.expr(f"coalesce(greatest({', '.join(terms)}, NULL), 0D)").alias(name)

    made = {
        "audio": channel("audio"),
        "img": channel("img"),
        **{c: F.when(F.col("environment"), F.col(c)).otherwise(0.0).alias(c) for c in ENV},
    }
    per_hub = {f"{c}_{j}" for c in ("audio", "img") for j in numbers}
    shared = [c for c in rows.columns if c not in {*per_hub, *CHANNELS, "home", "active"}]
    listed = runs.select("home", "active", "signs", "high", "low", "environment",
                         *[k for k in keys if k != "environment"])
    return rows.join(listed, ["home", "active"]).select("home", *keys, *made.values(), *shared)


# --- model-free variant on inference tables -------------------------------------------


def hub_states(inferences: DataFrame) -> DataFrame:
    """Count distinct hub states per home, day and label.

    Equals the full outer join of all hubs on (day, time, label), followed by counting
    equal rows.  One row per sample time shrinks to a few states per day before any run
    looks at it.  A hub holds a time and label once; as a set, a state stays within nine
    entries per hub whatever the input repeats.
    """
    entry = F.struct("hub", "audio", "img")
    return (
        inferences.groupBy("home", "day", "hr_min_sec", "occupied")
        .agg(F.array_sort(F.collect_set(entry)).alias("state"))
        .groupBy("home", "day", "occupied", "state")
        .agg(F.count("*").alias("n"))
    )


def hubs_of_states(states: DataFrame) -> DataFrame:
    """Home and hub pairs that occur in the states."""
    return states.select("home", F.explode("state.hub").alias("hub")).distinct()


def outer_join_hubs(inferences: DataFrame, channel: str, hubs: Sequence[str]) -> DataFrame:
    """Full outer join of hubs on (day, time, label): a ``<channel>_<digit>`` column each."""
    return inferences.where(F.col("hub").isin(*hubs)).groupBy(
        "home", "day", "hr_min_sec", "occupied"
    ).agg(
        *[
            F.max(F.when(F.col("hub") == h, F.col(channel))).alias(f"{channel}_{h[2:]}")
            for h in hubs
        ]
    )


def drop_sentinels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without -1 in any of the columns; NULL passes."""
    keep = F.lit(True)
    for c in columns:
        keep = keep & (F.coalesce(F.col(c), F.lit(0)) != -1)
    return df.where(keep)


def runs_on_states(
    states: DataFrame, runs: DataFrame, hubs: DataFrame, comparison: str
) -> DataFrame:
    """Every state under every run of its home.

    Adds ``picked``, the (column, value) pairs the run sees, ``is_null_run`` and
    ``complete`` (no -1 among them).  A run without channels sees one column, ``null``,
    that is always 1.  Runs meet states on home and day.
    """
    high, low = designs.split_comparison(comparison)
    names = hubs.groupBy("home").agg(F.array_sort(F.collect_set("hub")).alias("hubs"))
    per_home = runs.join(names, "home").withColumn(
        "channels",
        F.map_from_arrays(
            "hubs", F.transform("signs", lambda s: F.when(s == 1, high).otherwise(low))
        ),
    )
    days = states.select("home", "day").distinct()
    per_day = spread(
        days.join(per_home.select("home", "run", "hubs", "channels"), "home"), "home", "day"
    )
    silent = f"forall(map_values(channels), c -> c = '{NO_CHANNEL}')"
    pick = (
        "named_struct('column', concat(channels[e.hub], '_', substr(e.hub, 3)), 'value', "
        "CASE channels[e.hub] WHEN 'img' THEN e.img WHEN 'audio' THEN e.audio END)"
    )
    alone = "array(named_struct('column', 'null', 'value', 1))"
    seen = f"filter(transform(state, e -> {pick}), p -> p.value IS NOT NULL)"
    picked = f"CASE WHEN {silent} THEN {alone} ELSE {seen} END"
    visible = "CASE WHEN is_null_run THEN exists(state, e -> e.hub = hubs[0]) " \
              "ELSE size(picked) > 0 END"
    return (
        states.join(per_day, ["home", "day"])
        .withColumns({"is_null_run": F.expr(silent), "picked": F.expr(picked)})
        .where(visible)
        .withColumn("complete", F.expr("forall(picked, p -> p.value <> -1)"))
        .select("home", "run", "day", "occupied", "n", "picked", "is_null_run", "complete")
    )


def sentinel_counts(seen: DataFrame) -> DataFrame:
    """Value counts per run and column, before and after sentinel rows are dropped."""
    stages = F.array(
        F.struct(F.lit("before").alias("stage"), F.lit(True).alias("counted")),
        F.struct(F.lit("after").alias("stage"), F.col("complete").alias("counted")),
    )
    long = (
        seen.withColumn("pick", F.explode("picked"))
        .withColumn("stage", F.explode(stages))
        .select(
            "home",
            "run",
            "pick.column",
            "pick.value",
            "stage.stage",
            F.when(F.col("stage.counted"), F.col("n")).otherwise(0).alias("n"),
        )
    )

    def count_of(value: int) -> Column:
        return F.sum(F.when(F.col("value") == value, F.col("n")).otherwise(0))

    return long.groupBy("home", "run", "column", "stage").agg(
        count_of(-1).alias("n_missing"),
        count_of(0).alias("n_0"),
        count_of(1).alias("n_1"),
        F.sum("n").alias("total"),
    )


def model_free_predictions(seen: DataFrame) -> DataFrame:
    """Occupied where any hub is positive; the run without channels always says occupied."""
    total = F.aggregate("picked", F.lit(0), lambda a, p: a + p["value"])
    predicted = F.when(F.col("is_null_run") | (total > 0), 1).otherwise(0)
    return (
        seen.where(F.col("complete") & (F.col("occupied") != -1))
        .withColumn("pred", predicted)
        .groupBy("home", "run", "day", "occupied", "pred")
        .agg(F.sum("n").alias("n"))
    )


def with_empty_days(predictions: DataFrame, runs: DataFrame, days: DataFrame) -> DataFrame:
    """Add a zero count for every run and day of a home, so days without rows are scored too."""
    grid = spread(days.join(runs.select("home", "run"), "home"), "home", "day")
    zero = F.lit(0).cast("long").alias("n")
    nothing = grid.select("home", "run", "day", F.lit(0).alias("occupied"), F.lit(0).alias("pred"), zero)
    return predictions.unionByName(nothing)


def daily_metrics(predictions: DataFrame) -> DataFrame:
    """Metrics per home, run and day from counted predictions; rates at 4 digits.

    A day whose counts are all zero has rates, F1 and accuracy 0.
    """

    def cell(label: int, pred: int) -> Column:
        hit = (F.col("occupied") == label) & (F.col("pred") == pred)
        return F.sum(F.when(hit, F.col("n")).otherwise(0))

    counts = predictions.groupBy("home", "run", "day").agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"),
        cell(1, 0).alias("fn"), cell(1, 1).alias("tp"),
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return with_rates(counts).select(
        "home",
        "run",
        "day",
        *[F.col(c) for c in ("tn", "fp", "fn", "tp")],
        *[sig_round(F.col(c.lower()), 4).alias(c) for c in ("FPR", "TPR", "FNR", "TNR")],
        ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("F1-Score"),
        ratio_or_zero(tp + tn, tn + fp + fn + tp).alias("Accuracy"),
    )


def run_statistics(daily: DataFrame) -> DataFrame:
    """Mean and population variance of the daily metrics per run."""
    return daily.groupBy("home", "run").agg(
        *[F.avg(m).alias(m) for m in DAILY_METRICS],
        *[F.var_pop(m).alias(f"var {m}") for m in DAILY_METRICS],
    )


def standard_error(statistics: DataFrame, days: DataFrame) -> DataFrame:
    """Standard error of each metric per home from the runs' daily variances."""
    n_days = days.groupBy("home").agg(F.countDistinct("day").alias("n_days"))
    per_home = statistics.groupBy("home").agg(
        F.count("*").alias("n_runs"), *[F.avg(f"var {m}").alias(m) for m in DAILY_METRICS]
    )
    ratio = F.col("n_days") / F.col("n_runs")
    return per_home.join(n_days, "home").select(
        "home",
        *[(F.sqrt(F.col(m) * ratio) / STANDARD_ERROR_DIVISOR).alias(m) for m in DAILY_METRICS],
    )


def experiment_report(
    statistics: DataFrame, errors: DataFrame, long_runs: DataFrame, hub_names: Sequence[str]
) -> DataFrame:
    """One row per run with signs per hub, a readable name and the metrics, plus SE rows."""
    pair = F.concat(F.lit("'"), "hub", F.lit("': '"), "channel", F.lit("'"))
    described = long_runs.groupBy("home", "run").agg(
        F.concat_ws(
            ", ",
            F.transform(
                F.array_sort(F.collect_list(F.struct("hub", pair.alias("pair")))),
                lambda p: p["pair"],
            ),
        ).alias("assigned"),
        *[F.max(F.when(F.col("hub") == h, F.col("sign"))).alias(h) for h in hub_names],
    )
    name = F.concat(F.lit("Run "), "run", F.lit(": {"), "assigned", F.lit("}"))
    rows = described.join(statistics, ["home", "run"]).select(
        "home",
        F.col("run").cast("string").alias("Run"),
        *hub_names,
        name.alias("Name"),
        *DAILY_METRICS,
    )
    return rows.unionByName(errors.withColumn("Run", F.lit("SE")), allowMissingColumns=True)


def look_ahead(
    samples: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = ("home", "hub", "day"),
    min_hours: float = 0.25,
    max_hours: float = 2.0,
    samples_per_day: int = 8640,
) -> DataFrame:
    """Hold each positive sample for a while that depends on the time of day.

    ``sample_no`` counts samples from midnight.  A positive sample at ``t`` keeps the
    column at 1 through ``t + w(t)``; only original positives start a hold.
    """
    per_hour = samples_per_day / 24
    low, high = min_hours * per_hour, max_hours * per_hour
    t = F.col("sample_no")
    angle = t * 2 * F.pi() / samples_per_day
    hold = F.rint((high - low) / 2 * F.cos(angle) + (high - low) / 2 + low)
    so_far = (
        Window.partitionBy(*keys).orderBy("sample_no").rowsBetween(Window.unboundedPreceding, 0)
    )
    return samples.withColumns(
        {
            c: F.when(F.max(F.when(F.col(c) == 1, t + hold)).over(so_far) >= t, 1).otherwise(
                F.col(c)
            )
            for c in columns
        }
    )

