"""Reproducible shuffle into shards: a Feistel permutation with cycle walking.

Every row gets a global row number (its rank by hash of the id, then id, size and checksum), the
permutation maps row numbers 0..N-1 onto positions 0..N-1, and position p lies in shard ``p % S``
at slot ``p // S``.  Counts per shard differ by one at most, slots have no gaps, and both follow
from the row number, N and the key alone.

Defined results: a null text counts as empty; rows with equal ids, size and checksum are
interchangeable, each gets a position of its own; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 8
WALK = 64


def row_numbers(df: DataFrame, key: str, ties: list[str], name: str, buckets: int = 4096) -> tuple[DataFrame, int]:
    """Add ``name``: a global row number, and return the number of rows.

    Rows are ranked inside hash buckets of the key; a table of ``buckets`` counts (so its size is
    fixed) gives each bucket's first number.  The first pass reads the key column only.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    counted = df.groupBy(bucket.alias("_bucket")).count()
    sizes = {r[0]: r[1] for r in counted.collect()}  # at most `buckets` rows
    first, total = [], 0
    for b in range(buckets):
        first.append(total)
        total += sizes.get(b, 0)
    spark = df.sparkSession
    starts = spark.createDataFrame([(b, first[b]) for b in sizes], "_bucket int, _first long")
    window = Window.partitionBy("_bucket").orderBy(key, *ties)
    ranked = df.withColumn("_bucket", bucket).withColumn("_rank", F.row_number().over(window) - 1)
    # A start row per bucket: at most `buckets` rows of two numbers.
    numbered = ranked.join(F.broadcast(starts), "_bucket")
    return numbered.withColumn(name, F.col("_first") + F.col("_rank")).drop("_bucket", "_first", "_rank"), total


def _div(value: Column, by: int) -> Column:
    """Whole-number quotient; a floating one would err beyond 2**53."""
    return F.call_function("div", value, F.lit(by).cast("long"))


def permuted(number: Column, total: int, key: str) -> Column:
    """Position of a row number under the keyed permutation of 0..total-1.

    The network works on pairs (l, r) of Z_a x Z_b, a * b just above total: each round adds a
    keyed hash of one half to the other, which is invertible.  A value at or above total walks
    on along its cycle until it falls below; fewer than a + 1 values lie there.
    """
    a = max(1, math.isqrt(max(total - 1, 0)) + 1)
    b = max(1, -(-total // a))

    def hashed(half: Column, turn: Column, size: int) -> Column:
        return F.pmod(F.xxhash64(half, turn, F.lit(key)), F.lit(size))

    def network(value: Column) -> Column:
        pair = F.struct(_div(value, b).alias("l"),
                        F.pmod(value, F.lit(b)).cast("long").alias("r"))

        def turn(p: Column, k: Column) -> Column:
            left = F.pmod(p["l"] + hashed(p["r"], k, a), F.lit(a)).cast("long")
            right = F.pmod(p["r"] + hashed(p["l"], k, b), F.lit(b)).cast("long")
            return F.when(k % 2 == 0, F.struct(left.alias("l"), p["r"].alias("r"))).otherwise(
                F.struct(p["l"].alias("l"), right.alias("r")))

        done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), pair, turn)
        return done["l"] * F.lit(b) + done["r"]

    steps = max(1, min(WALK, a * b - total))
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), network(number),
                         lambda v, _: F.when(v < F.lit(total), v).otherwise(network(v)))
    return F.when(walked < F.lit(total), walked).otherwise(
        F.raise_error(F.lit("cycle walk longer than its bound")).cast("long"))


def shard(documents: DataFrame, shards: int = 8, key: str = "shuffle-1") -> DataFrame:
    """doc_id, size (bytes plus 1), text_crc32, row_number, position, shard, slot."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = documents.select(
        F.col("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    # The counting pass reads ids only: Spark prunes the text there.
    numbered, total = row_numbers(slim, "doc_id", ["size", "text_crc32"], "row_number")
    placed = numbered.withColumn("position", permuted(F.col("row_number"), total, key))
    return placed.select("*", F.pmod("position", F.lit(shards)).cast("int").alias("shard"),
                         _div(F.col("position"), shards).alias("slot"))
