"""Factorial effects of hubs and hub pairs on the metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomtide.operators.factorial import BASELINE_RUN
from roomtide.schemas import EFFECT_METRICS


def split_columns(results: DataFrame) -> tuple[list[str], list[str]]:
    """Hub columns and metric columns of a result table."""
    hubs = [c for c in results.columns if "RS" in c or "BS" in c]
    return hubs, [c for c in results.columns if c in EFFECT_METRICS]


def factors(runs: DataFrame, hubs: DataFrame, level: int = 1) -> DataFrame:
    """One row per home, run and combination of ``level`` hubs: ``factor`` and ``sign``.

    Level 1 gives the hubs themselves, level 2 the interactions ``AxB``; the sign is the
    product over the hubs.  ``hubs`` lists home and hub.  Combinations are of a design's
    hubs, a row per run.
    """
    names = hubs.groupBy("home").agg(F.array_sort(F.collect_set("hub")).alias("names"))
    numbers = "sequence(1, size(names))"
    combos = (
        f"transform({numbers}, i -> named_struct("
        "'last', i, 'factor', names[i - 1], 'sign', signs[i - 1]))"
    )
    for depth in range(2, level + 1):
        c, j = f"c{depth}", f"j{depth}"
        combos = (
            f"flatten(transform({combos}, {c} -> "
            f"transform(filter({numbers}, {j} -> {j} > {c}.last), {j} -> named_struct("
            f"'last', {j}, 'factor', concat({c}.factor, 'x', names[{j} - 1]), "
            f"'sign', {c}.sign * signs[{j} - 1]))))"
        )
    return (
        runs.join(names, "home")
        .select("home", "run", F.explode(F.expr(combos)).alias("f"))
        .select("home", "run", "f.factor", "f.sign")
    )


def effects(
    signs: DataFrame,
    metrics: DataFrame,
    names: Sequence[str] = EFFECT_METRICS,
    count_baseline: bool = True,
) -> DataFrame:
    """``sum(sign * metric) / (rows / 2)`` per home and factor.

    The baseline run has sign 0 and so only enters the divisor; leave it out with
    ``count_baseline=False`` for the textbook contrast.
    """
    rows = metrics if count_baseline else metrics.where(F.col("run") != BASELINE_RUN)

    def effect(name: str) -> Column:
        return F.sum(F.col("sign") * F.col(f"`{name}`")) / (F.count("*") / 2)

    return (
        signs.join(rows, ["home", "run"])
        .groupBy("home", "factor")
        .agg(*[effect(n).alias(n) for n in names])
    )


def baseline_and_average(
    metrics: DataFrame, names: Sequence[str] = EFFECT_METRICS
) -> DataFrame:
    """Rows ``BL`` (the baseline run) and ``avg`` (mean of the other runs) per home."""
    is_baseline = F.col("run") == BASELINE_RUN
    both = metrics.groupBy("home").agg(
        F.struct(
            *[F.max(F.when(is_baseline, F.col(f"`{n}`"))).cast("double").alias(n) for n in names]
        ).alias("BL"),
        F.struct(*[F.avg(F.when(~is_baseline, F.col(f"`{n}`"))).alias(n) for n in names]).alias(
            "avg"
        ),
    )
    rows = F.array(
        *[F.struct(F.lit(n).alias("factor"), F.col(n).alias("v")) for n in ("BL", "avg")]
    )
    return both.select("home", F.explode(rows).alias("r")).select("home", "r.factor", "r.v.*")


def effects_table(
    runs: DataFrame,
    hubs: DataFrame,
    metrics: DataFrame,
    names: Sequence[str] = EFFECT_METRICS,
) -> DataFrame:
    """BL, avg, main effects and two-factor interactions of every metric, per home."""
    signs = factors(runs, hubs).unionByName(factors(runs, hubs, 2))
    return baseline_and_average(metrics, names).unionByName(effects(signs, metrics, names))


def effects_of_results(results: DataFrame) -> DataFrame:
    """Effects table from stored results: home, run, a sign column per hub, and metrics."""
    hub_columns, metric_columns = split_columns(results)
    hub_columns = sorted(hub_columns)
    signs = F.array(*[F.col(h) for h in hub_columns])
    runs = results.select(
        "home", "run", F.filter(signs, lambda s: s.isNotNull()).alias("signs")
    )
    present = F.array(*[F.when(F.col(h).isNotNull(), F.lit(h)) for h in hub_columns])
    hubs = (
        results.select("home", F.explode(present).alias("hub"))
        .where(F.col("hub").isNotNull())
        .distinct()
    )
    return effects_table(runs, hubs, results.select("home", "run", *metric_columns),
                         metric_columns)
