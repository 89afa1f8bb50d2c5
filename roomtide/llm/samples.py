"""Bounded samples of labelled texts, chosen by hash without moving a text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from roomtide.runtime import stage


def lowest(listed: DataFrame, wanted: int) -> list[Row]:
    """label and hash of the ``wanted`` lowest distinct hashes of every label, or all if there are fewer.

    ``listed``: label, hash (long); no texts.  Exact counts give each label a bound on the hash that
    about twice the wanted rows pass, so the ranking of a label sees that many rows however large
    it is; should fewer than wanted pass, the bounds are raised.
    """
    distinct = stage(listed.select("label", "hash").distinct())
    counts = distinct.groupBy("label").agg(F.count("*").alias("n"))
    share = F.col("hash").cast("double") / F.lit(2.0 ** 64) + 0.5
    rank = F.row_number().over(Window.partitionBy("label").orderBy("hash"))
    room = 2.0
    while True:
        # A row for each label; the sample itself holds ``wanted`` rows of each.
        below = distinct.join(F.broadcast(counts), "label").where(share * F.col("n") <= F.lit(room * wanted + 100))
        found = below.withColumn("rank", rank).where(F.col("rank") <= wanted).select("label", "hash", "n").collect()
        per: dict = {}
        for r in found:
            per[r.label] = per.get(r.label, 0) + 1
        short = counts.count() > len(per) or any(per[r.label] < min(wanted, r.n) for r in found)
        if not short:
            return found
        room *= 16


def texts_of(rows: DataFrame, chosen: list[Row]) -> list[tuple]:
    """(hash, label, text) of the chosen rows in order; ``rows``: hash, text.  Equal texts count once."""
    if not chosen:
        return []
    wanted = rows.sparkSession.createDataFrame([(r.hash,) for r in chosen], "hash long").distinct()
    # As many numbers as the sample has texts.
    found = rows.join(F.broadcast(wanted), "hash", "left_semi").select("hash", "text").distinct().collect()
    texts: dict[int, str] = {}
    for r in found:
        texts[r.hash] = min(r.text, texts.get(r.hash, r.text))
    return sorted((r.hash, r.label, texts[r.hash]) for r in chosen)
