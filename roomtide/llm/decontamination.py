"""Find benchmark items inside documents: size-partitioned MinHash containment search.

A text's set is its distinct five-word shingles, in lower case (of any script, not only A-Z), so a
passage is found in upper-cased copies too.  An item is found in a document that holds at
least 80 % of the item's shingles, wherever they stand.

Items are partitioned by the size of their sets.  A partition has one signature length, which
follows from its largest possible size u: any set that contains 80 % of an item of q <= u
shingles misses fewer than ``floor(0.2 u) + 1`` of them, so it shares at least one of the item's
that many smallest hashes (its bottom MinHash values).  Documents without such a value are no
candidates; candidates are verified on the shingle texts.  So nothing is missed by chance.

Documents are read once.  Bit maps of fixed size over the hashes (of all item shingles, and of
signatures alone) reach the tasks; what passes them is joined with the items by shuffle, which
also takes a benchmark of any size.

Defined results: items of one to four words have one shingle, the whole item, looked for among a
document's runs of as many words; empty and null items and documents match nothing; documents
that agree in id and text count once; items with equal ids count apart by text; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.llm.bitmaps import bitmap, slots, unpacked
from roomtide.llm.names import unused
from roomtide.llm.words import Hasher, shingles, slices, words_of
from roomtide.runtime import stage

WORDS = 5
CONTAINED = 0.8
SLICE = 1 << 20


def item_shingles(benchmark: DataFrame, words: int = WORDS, contained: float = CONTAINED) -> DataFrame:
    """item, item_id, n (words a shingle), size, part, hash, shingle, signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches, "text"):
            found = words_of(batch.column("text"), hasher)
            rows: list[tuple] = []
            for d in range(batch.num_rows):
                lo, hi = int(found.first[d]), int(found.first[d + 1])
                if lo == hi:
                    continue
                n = min(words, hi - lo)
                values, at = np.unique(shingles(found.hashes[lo:hi], n), return_index=True)
                size = len(values)
                part = size.bit_length() - 1
                largest = (1 << (part + 1)) - 1
                length = largest - int(np.ceil(contained * largest - 1e-9)) + 1
                for rank, (h, i) in enumerate(zip(values, at)):
                    text = " ".join(found.word(lo + int(i) + k) for k in range(n))
                    rows.append((batch.column("item")[d].as_py(), batch.column("item_id")[d].as_py(), n,
                                 size, part, int(h.view(np.int64)), text, rank < length))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(names, row)) for row in rows], schema=kind)

    key = benchmark.select("item_id", F.col("text").cast("string").alias("text")).withColumn(
        "item", F.xxhash64("item_id", "text")).withColumn("text", F.lower("text"))
    names = ["item", "item_id", "n", "size", "part", "hash", "shingle", "signature"]
    id_type = benchmark.schema["item_id"].dataType.simpleString()
    kind = pa.schema([("item", pa.int64()), ("item_id", _arrow(benchmark, "item_id")), ("n", pa.int32()),
                      ("size", pa.int64()), ("part", pa.int32()), ("hash", pa.int64()),
                      ("shingle", pa.string()), ("signature", pa.bool_())])
    return key.mapInArrow(run, f"item long, item_id {id_type}, n int, size long, part int, hash long, "
                               "shingle string, signature boolean").dropDuplicates(["item", "hash"])


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def hits(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, print (of the text), size, n, hash, shingle: runs of words that may be item shingles,
    for documents with a possible signature value."""
    spark = documents.sparkSession
    lengths = sorted(r[0] for r in items.select("n").distinct().collect())  # at most `words` rows
    shared = spark.sparkContext.broadcast(
        (bitmap(items, "hash"), bitmap(items.where("signature"), "hash")))
    id_kind = _arrow(documents, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        every, signature = map(unpacked, shared.value)
        for batch in slices(batches, "text", SLICE):
            found = words_of(batch.column("text"), hasher)
            doc_of = np.repeat(np.arange(batch.num_rows), np.diff(found.first))
            out: list[list] = [[], [], [], [], []]
            for n in lengths:
                if len(found.hashes) < n:
                    continue
                runs = shingles(found.hashes, n)
                bits = slots(runs)
                inside = doc_of[:len(runs)] == doc_of[n - 1:]
                candidates = np.zeros(batch.num_rows, bool)
                candidates[doc_of[:len(runs)][inside & signature[bits]]] = True
                at = np.flatnonzero(inside & every[bits] & candidates[doc_of[:len(runs)]])
                if not len(at):
                    continue
                keys = np.stack([doc_of[at].astype(np.uint64), runs[at]])
                _, keep = np.unique(keys, axis=1, return_index=True)
                for i in at[keep]:
                    out[0].append(int(doc_of[i]))
                    out[1].append(n)
                    out[2].append(int(runs[i].view(np.int64)))
                    out[3].append(" ".join(found.word(int(i) + k) for k in range(n)))
            if out[0]:
                rows = pa.array(out[0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows), batch.column("print").take(rows), pa.array(out[1], pa.int32()),
                     pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())],
                    schema=pa.schema([("doc_id", id_kind), ("print", pa.int64()), ("n", pa.int32()),
                                      ("hash", pa.int64()), ("shingle", pa.string())]))

    id_type = documents.schema["doc_id"].dataType.simpleString()
    source = documents.select("doc_id", F.col("text").cast("string").alias("text")).withColumn(
        "print", F.xxhash64("text")).withColumn("text", F.lower("text"))
    return source.mapInArrow(run, f"doc_id {id_type}, print long, n int, hash long, shingle string")


def contaminated(documents: DataFrame, benchmark: DataFrame, words: int = WORDS,
                 contained: float = CONTAINED) -> DataFrame:
    """doc_id, print, item_id, item, part, matched, item_size, containment of every contained item."""
    items = stage(item_shingles(benchmark, words, contained))
    found = hits(documents, items).withColumnRenamed("n", "_n")
    wanted = items.withColumnRenamed("n", "_m").drop("item_id")
    joined = found.join(wanted, (found["hash"] == wanted["hash"]) & (found["shingle"] == wanted["shingle"])
                        & (F.col("_n") == F.col("_m")))
    counted = joined.groupBy("doc_id", "print", "item").agg(
        F.countDistinct(found["hash"]).alias("matched"), F.max("signature").alias("candidate"),
        F.first("size").alias("item_size"), F.first("part").alias("part"))
    names = items.select("item", "item_id").distinct()
    return (counted.where("candidate").where(F.col("matched") >= F.ceil(F.col("item_size") * F.lit(contained) - 1e-9))
            .join(names, "item")
            .select("doc_id", "print", "item_id", "item", "part", "matched", "item_size",
                    (F.col("matched") / F.col("item_size")).alias("containment")))


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that contain no item, columns unchanged."""
    own, same = unused(documents.columns, "id", "print")
    bad = contaminated(documents, benchmark).select(
        F.col("doc_id").alias(own), F.col("print").alias(same)).distinct()
    return documents.join(bad, F.col("doc_id").eqNullSafe(F.col(own))
                          & (F.xxhash64(F.col("text").cast("string")) == F.col(same)), "left_anti")
