"""Vector code compression: product codes of whole-number vectors, by tries over distinct parts.

Each component x becomes floor(1024 * x), and a vector is cut into equal consecutive parts.  Every
part position has a codebook, which starts as that part of the vectors of the smallest ids and is
improved in rounds: each part goes to the nearest entry (squared Euclidean distance, ties to the
lower index), then each entry becomes the floor of its parts' mean; unused entries stay.

All distances of a sorted block of parts come from their lexicographic trie, walked depth first: a
node stands for a common prefix and holds the accumulated distances of that prefix to all entries,
computed once from its parent's; the leaves, the distinct parts, take the nearest entry and add
themselves, times their number, to its sums.  Equal parts of the whole table are counted first
(on the map side, so a part that a third of all rows hold is one row) and written once, sorted;
every round reads that table and returns at most parts x entries sums.  The codebooks, a fixed
number of entries, go to the tasks.  The final codes are found where the vectors lie: only labels
are grouped, and nothing of a vector is shuffled or joined back.

Defined results: vectors that are null, empty, or hold null or non-finite components are dropped;
a null id is kept and comes last among the ids; rows of one id come by vector, each a row of its own;
the length is that of the smallest id's vector, and vectors of another length have null code and
errors; a length that the parts do not divide
is filled up with zeros; components whose distances exceed 64 bits are refused; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomtide.runtime import stage

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
BLOCK = 4096


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


class Trie:
    """Distances of sorted parts to the entries of one codebook, shared along common prefixes.

    The path to the last leaf is kept, so the walk goes on from one block of parts to the next.
    """

    def __init__(self, book: np.ndarray) -> None:
        self.book = book.astype(np.int64)
        self.path: np.ndarray | None = None
        self.last: np.ndarray | None = None

    def walk(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest entry and distance of every part (rows in lexicographic order), and the nodes visited."""
        n, depth = parts.shape
        before = parts[:1] - 1 if self.last is None else self.last[None]
        differs = parts != np.concatenate([before, parts[:-1]])
        # A row opens a new node on every level from the first differing component on.
        opens = np.logical_or.accumulate(differs, axis=1)
        above, row_of = np.zeros((1, len(self.book)), np.int64), np.zeros(n, np.int64)
        path = np.zeros((depth, len(self.book)), np.int64)
        visited = 0
        for level in range(depth):
            new = np.flatnonzero(opens[:, level])
            gap = parts[new, level, None] - self.book[None, :, level]
            fresh = above[row_of[new]] + gap * gap
            visited += len(new)
            # Rows before the first new node still lie below the node that the last block ended in.
            kept = 1 if not opens[0, level] else 0
            if kept:
                fresh = np.concatenate([self.path[level][None], fresh])
            row_of = np.cumsum(opens[:, level]) - 1 + kept
            above = fresh
            path[level] = fresh[-1]
        self.path, self.last = path, parts[-1]
        nearest = above.argmin(1)
        return nearest[row_of], above[np.arange(len(above)), nearest][row_of], visited


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.int64).reshape(-1, width)


def prepared(embeddings: DataFrame) -> tuple[DataFrame, int]:
    """vec_id, label and ``whole`` (array of whole numbers) of usable rows, and the vectors' length."""
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select("vec_id", "label", vector.alias("embedding")).where(_usable(F.col("embedding")))
    most = rows.agg(F.max(F.size("embedding")), F.max(F.array_max(F.transform("embedding", F.abs)))).head()
    longest, greatest = most[0] or 0, most[1] or 0.0
    # Every sum of squared differences must fit in 63 bits; then components fit in 32.
    if longest * (2 * (greatest * SCALE + 1)) ** 2 >= 2 ** 62:
        raise ValueError(f"components up to {greatest} give errors beyond 64 bits")
    whole = F.transform("embedding", lambda x: F.floor(x * SCALE).cast("int"))
    rows = rows.select("vec_id", "label", whole.alias("whole"))
    head = _in_order(rows).select(F.size("whole")).head()
    return rows, head[0] if head else 0


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.col("vec_id").asc_nulls_last(), "whole")


def _cut(whole: Column, length: int, parts: int) -> list[Column]:
    width = -(-length // parts)
    filled = F.concat(whole, F.array_repeat(F.lit(0), width * parts - length)) if length % parts else whole
    return [F.slice(filled, p * width + 1, width) for p in range(parts)]


def first_books(rows: DataFrame, length: int, parts: int, entries: int) -> np.ndarray:
    """Parts of the vectors of the ``entries`` smallest ids: an array by part, entry and component."""
    width = -(-length // parts)
    # A top list of fixed length, with a limit in every task before it.
    least = _in_order(rows.where(F.size("whole") == length)).limit(entries).collect()
    books = np.zeros((len(least), width * parts), np.int64)
    if least:
        books[:, :length] = [r.whole for r in least]
    return books.reshape(len(least), parts, width).transpose(1, 0, 2)


def distinct_parts(rows: DataFrame, length: int, parts: int) -> DataFrame:
    """position, part and its number of rows; written once, sorted within files, equal parts once."""
    pieces = F.array(*[F.struct(F.lit(p).alias("position"), piece.alias("part"))
                       for p, piece in enumerate(_cut(F.col("whole"), length, parts))])
    single = rows.where(F.size("whole") == length).select(F.explode(pieces).alias("s")).select("s.*")
    counted = single.groupBy("position", "part").agg(F.count("*").alias("rows"))
    return stage(counted.sortWithinPartitions("position", "part"))


def _improved(distinct: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: entries become the floor of the mean of the parts nearest to them."""
    shared = distinct.sparkSession.sparkContext.broadcast(books)  # parts x entries, a fixed number
    width = books.shape[2]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        tries = [Trie(book) for book in books]
        sums = np.zeros((*books.shape[:2], width + 1), np.int64)
        for batch in batches:
            where = batch.column("position").to_numpy()
            number = batch.column("rows").to_numpy()
            matrix = _matrix(batch.column("part"), width)
            for p in np.unique(where).tolist():
                own = np.flatnonzero(where == p)
                for at in range(0, len(own), BLOCK):
                    block = own[at:at + BLOCK]
                    leaves = matrix[block]
                    entry, _, _ = tries[p].walk(leaves)
                    weighted = np.concatenate([leaves, np.ones((len(leaves), 1), np.int64)], 1) * number[block, None]
                    np.add.at(sums[p], entry, weighted)
        p, e = np.nonzero(sums[:, :, -1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()),
             pa.ListArray.from_arrays(np.arange(0, len(p) * (width + 1) + 1, width + 1, dtype=np.int32),
                                      pa.array(sums[p, e].ravel()))], ["position", "entry", "sums"])

    found = distinct.mapInArrow(partial, "position int, entry int, sums array<long>")
    totals = found.groupBy("position", "entry").agg(
        *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width + 1)]).collect()  # parts x entries rows
    out = books.copy()
    for p, e, *sums in totals:
        out[p, e] = [total // sums[-1] for total in sums[:-1]]
    shared.unpersist()
    return out


def train(rows: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks of prepared rows, by part, entry and component."""
    books = first_books(rows, length, parts, entries)
    if books.shape[1]:
        distinct = distinct_parts(rows, length, parts)
        for _ in range(rounds):
            books = _improved(distinct, books)
    return books


def assigned(rows: DataFrame, books: np.ndarray, length: int) -> DataFrame:
    """vec_id, label, ``entries`` (array of 0-based indexes in part order) and ``error`` of every row."""
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(books)
    parts, _, width = books.shape
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, entries array<int>, error long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            whole = batch.column("whole")
            fits = np.diff(whole.offsets.to_numpy()) == length
            matrix = np.zeros((int(fits.sum()), parts * width), np.int64)
            matrix[:, :length] = _matrix(whole.filter(pa.array(fits)), length)
            chosen, error = np.zeros((len(matrix), parts), np.int32), np.zeros(len(matrix), np.int64)
            for p, book in enumerate(books):
                leaves, row = np.unique(matrix[:, p * width:(p + 1) * width], axis=0, return_inverse=True)
                trie, nearest, distance = Trie(book), [], []
                for at in range(0, len(leaves), BLOCK):
                    entry, far, _ = trie.walk(leaves[at:at + BLOCK])
                    nearest.append(entry)
                    distance.append(far)
                if nearest:
                    chosen[:, p] = np.concatenate(nearest)[row.ravel()]
                    error += np.concatenate(distance)[row.ravel()]
            place = np.cumsum(fits) - 1
            codes = pa.ListArray.from_arrays(np.arange(0, chosen.size + 1, parts, dtype=np.int32), pa.array(chosen.ravel()))
            take = pa.array(np.where(fits, place, 0), pa.int64(), mask=~fits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), codes.take(take), pa.array(error).take(take)],
                ["vec_id", "label", "entries", "error"])

    return rows.mapInArrow(run, schema)


def digest(books: np.ndarray) -> str:
    """sha256 of all entries' components, by part, entry and component, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, entries, error and label_error of every usable vector, and the codebooks."""
    rows, length = prepared(embeddings)
    books = train(rows, length, parts, entries, rounds)
    coded = stage(assigned(rows, books, length))
    # One row a label; a label of many rows is added up before the shuffle and its rows can be split.
    totals = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    whole = coded.join(totals, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
    return whole.select("vec_id", "label", "entries", "error", "label_error"), books


def code(entries: Column) -> Column:
    """Two hexadecimal digits for every index."""
    return F.array_join(F.transform(entries, lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "")
