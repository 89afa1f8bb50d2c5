"""Two-level factorial designs and what they assign to each hub."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomtide.runtime import spread

#: Runs that one row is expanded to.
CHUNK_BITS = 12


def split_comparison(comparison: str) -> tuple[str, str]:
    """``img_audio`` -> channels for sign +1 and -1."""
    high, low = comparison.split("_")
    return high, low


def number_hubs(hubs: DataFrame) -> DataFrame:
    """Number the hubs of each home by name; ``n_hubs`` is their count."""
    home = Window.partitionBy("home")
    return hubs.select(
        "home",
        "hub",
        F.row_number().over(home.orderBy("hub")).alias("hub_no"),
        F.count("*").over(home).cast("int").alias("n_hubs"),
    )


def _free(level: str, generators: Sequence[Sequence[int]] | None) -> str:
    """Number of hubs whose signs a run number spells out."""
    if generators is not None:
        return f"n_hubs - {len(generators)}"
    if level not in ("full", "half"):
        raise ValueError(f"unknown level {level!r}")
    return "n_hubs" if level == "full" else "n_hubs - 1"


def _signs(level: str, generators: Sequence[Sequence[int]] | None) -> Column:
    """Signs of a run as an array, first hub first.

    Run numbers count in binary with the first hub as the highest bit.  The sign of a hub
    beyond the free ones is the product of its generator's; in the half fraction, of all.
    """
    bits = "transform(sequence(1, free), j -> if(shiftright(run - 1, free - j) & 1 = 1, 1, -1))"
    if generators is None:
        last = [f"aggregate({bits}, 1, (a, b) -> a * b)"] if level == "half" else []
    else:
        last = [" * ".join(f"if(shiftright(run - 1, free - {j}) & 1 = 1, 1, -1)" for j in g) for g in generators]
    return F.expr(f"concat({bits}, array({', '.join(last)}))" if last else bits)


def design(
    hubs: DataFrame, level: str = "full", generators: Sequence[Sequence[int]] | None = None
) -> DataFrame:
    """One row per home and run with its array of signs, in hub order.

    ``hubs`` lists home and hub; ``level`` is ``full`` or ``half``.  Other fractions of
    2 ** (k - p) runs are given by p ``generators``, one for each of a home's last p hubs: the
    numbers of the free hubs whose signs it multiplies.  Runs are numbered by bit operations
    in chunks, so no list of all runs exists; run numbers are 32-bit.
    """
    per_home = hubs.groupBy("home").agg(F.count("*").cast("int").alias("n_hubs"))
    free = F.expr(_free(level, generators))
    needed = max((j for g in generators for j in g), default=1) if generators else 0
    usable = (free >= needed) & (free <= 30)
    guarded = F.when(usable, free).otherwise(
        F.raise_error(F.lit("a design needs at most 30 free hubs, and free hubs for its generators")).cast("int")
    )
    chunks = (
        per_home.withColumn("free", guarded)
        .withColumn("low", F.least("free", F.lit(CHUNK_BITS)))
        .withColumn("chunk", F.explode(F.expr("sequence(0, shiftleft(1, free - low) - 1)")))
    )
    return (
        spread(chunks, "home", "chunk")
        .withColumn("at", F.explode(F.expr("sequence(1, shiftleft(1, low))")))
        .withColumn("run", F.expr("shiftleft(chunk, low) + at"))
        .withColumn("signs", _signs(level, generators))
        .select("home", "n_hubs", "run", "signs")
    )


def long_design(runs: DataFrame, hubs: DataFrame) -> DataFrame:
    """One row per home, run and hub with its sign."""
    return (
        runs.select("home", "run", F.posexplode("signs").alias("at", "sign"))
        .withColumn("hub_no", F.col("at") + 1)
        .join(number_hubs(hubs).drop("n_hubs"), ["home", "hub_no"])
        .select("home", "run", "hub", "hub_no", "sign")
    )


def assign_channels(long_runs: DataFrame, comparison: str) -> DataFrame:
    """Add the channel each hub contributes in each run."""
    high, low = split_comparison(comparison)
    return long_runs.withColumn("channel", F.when(F.col("sign") == 1, high).otherwise(low))


def hub_columns(long_runs: DataFrame, hub_names: Sequence[str]) -> DataFrame:
    """Signs of a run as one column per hub name; NULL where a home lacks the hub."""
    return long_runs.groupBy("home", "run").agg(
        *[F.max(F.when(F.col("hub") == h, F.col("sign"))).alias(h) for h in hub_names]
    )
