"""Runs of repeated words, found by recompression.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and
length at least max(24, 3 q) that neither neighbouring word extends.  Texts of a batch, a separator
of its own before each, form one word sequence.  Recompression turns it into a run-length grammar:
in turn, blocks of one symbol and pairs across a partition of the alphabet get new symbols, equal
stretches equal ones, until every text is one symbol.  Longest common extensions to both sides are
answered by climbing while whole symbols agree and descending where they differ.

Candidates lie on a harmonic grid.  A run of period q holds at least s = max(24 - q, 2 q)
consecutive positions i whose word equals that at i + q, so one of them is a multiple of s; over
all q these are O(n log n) positions, and the extensions around each give the exact run.  Spans
found with several periods keep the smallest, of which the others are multiples.

The work of a text lies in one task, in memory proportional to its words (about 150 bytes each);
no row meets another one, so nothing is shuffled and a lost task is simply run again.

Defined results: a null, empty or blank text has no words, no runs and an empty collapsed text;
equal rows get equal results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomtide.llm.words import mixed, slices

SHORTEST = 24
CANDIDATES = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in order, and the len + 1 offsets of each text's words."""
    texts = texts.cast(pa.large_string()).fill_null("")
    parts = pc.ascii_split_whitespace(texts)  # at exactly the bytes 0x20 and 0x09-0x0D
    flat = parts.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return flat.filter(real), before[parts.offsets.to_numpy() - parts.offsets[0].as_py()]


class Grammar:
    """Levels of a recompressed sequence, one after the other in flat arrays.

    ``symbol`` and ``size`` (in words) describe a node; ``up`` is its parent on the next level,
    ``child`` its first node on the level below (-1: none); ``ahead`` and ``behind`` count the equal
    symbols from a node on to either side, itself included, that the next level makes one block.
    """

    def __init__(self, words: np.ndarray, separators: int) -> None:
        """``words``: symbols from 0; those below ``separators`` are unique and never compressed."""
        self.symbol: list[np.ndarray] = []
        self.size: list[np.ndarray] = []
        self.up: list[np.ndarray] = []
        self.child: list[np.ndarray] = [np.full(len(words), -1, np.int32)]
        self.ahead: list[np.ndarray] = []
        self.behind: list[np.ndarray] = []
        symbol, size = words.astype(np.int64), np.ones(len(words), np.int32)
        self.offset, fresh, turn = 0, int(words.max(initial=0)) + 1, 0
        while True:
            starts = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
            if len(starts) < len(symbol):
                counts = np.diff(np.append(starts, len(symbol)))
                block = np.repeat(np.arange(len(starts)), counts)
                at = np.arange(len(symbol)) - starts[block]
                self._close(symbol, size, starts, block, counts[block] - at, at + 1)
                symbol, size = symbol[starts], size[starts] * counts.astype(np.int32)
                many = counts > 1
                symbol[many], fresh = self._named(symbol[many], counts[many], fresh)
            free = symbol >= separators
            beside = free[:-1] & free[1:]
            if not beside.any():
                break
            turn += 1
            side = (mixed(symbol + turn * 0x9E3779B9) >> np.uint64(40)) & np.uint64(1) == 1
            pairs = [beside & (side[:-1] == one) & (side[1:] != one) for one in (False, True)]
            first = np.flatnonzero(max(pairs, key=np.count_nonzero))
            if not len(first):
                continue
            kept = np.ones(len(symbol), bool)
            kept[first + 1] = False
            starts, parent = np.flatnonzero(kept), np.cumsum(kept) - 1
            one = np.ones(len(symbol), np.int32)
            self._close(symbol, size, starts, parent, one, one)
            named, fresh = self._named(symbol[first], symbol[first + 1], fresh)
            size[first] += size[first + 1]
            symbol, size = symbol.copy(), size[starts]
            symbol[first] = named
            symbol = symbol[starts]
        one = np.ones(len(symbol), np.int32)
        self._close(symbol, size, None, None, one, one)
        # One place more, so that the node after the last one can be asked for its child.
        self.child.append(np.full(1, self.offset - len(symbol), np.int32))
        for name in ("symbol", "size", "up", "child", "ahead", "behind"):
            setattr(self, name, np.concatenate(getattr(self, name)))

    @staticmethod
    def _named(left: np.ndarray, right: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
        """New symbols, one for each distinct pair of numbers below 2**31."""
        found, row = np.unique(left << 32 | right, return_inverse=True)
        return fresh + row.ravel(), fresh + len(found)

    def _close(self, symbol, size, starts, parent, ahead, behind) -> None:
        below = self.offset
        self.offset += len(symbol)
        self.symbol.append(symbol.astype(np.int32))
        self.size.append(size.copy())
        self.ahead.append(ahead.astype(np.int32))
        self.behind.append(behind.astype(np.int32))
        if starts is None:
            self.up.append(np.full(len(symbol), -1, np.int32))
        else:
            self.up.append((self.offset + parent).astype(np.int32))
            self.child.append((below + starts).astype(np.int32))

    def extensions(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """Words that agree from positions a < b on, to the right or, if ``back``, to the left.

        A pair of nodes, always of one level, moves up while both begin their parents and these
        agree, moves past equal symbols (of a block as many as both have left), and goes down
        where symbols differ; it ends at differing words.
        """
        out = np.zeros(len(a), np.int64)
        todo = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        symbol, up, child = self.symbol, self.up, self.child
        left, sign = (self.behind, -1) if back else (self.ahead, 1)

        def edge(node: np.ndarray) -> np.ndarray:
            """First child, or last one to the left."""
            return child[node + 1] - 1 if back else child[node]

        while len(todo):
            above_a, above_b = up[a], up[b]
            climb = (above_a >= 0) & (symbol[above_a] == symbol[above_b])
            climb &= (edge(above_a) == a) & (edge(above_b) == b)
            equal = ~climb & (symbol[a] == symbol[b])
            steps = np.where(equal, np.minimum(left[a], left[b]), 0)
            out[todo] += steps * self.size[a].astype(np.int64)
            lower = ~climb & ~equal
            live = ~lower | (child[a] >= 0)
            a, b = (np.where(climb, above, np.where(lower, edge(x), x + sign * steps))
                    for x, above in ((a, above_a), (b, above_b)))
            if not live.all():
                a, b, todo = a[live], b[live], todo[live]
        return out


def candidates(words: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grid positions whose word recurs q later, with q; text d is words[first[d]:][:sizes[d]]."""
    texts = np.flatnonzero(sizes >= SHORTEST)
    periods = sizes[texts] // 3
    places, spans = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    ends = np.cumsum(periods)
    for lo in range(0, int(periods.sum()), CANDIDATES):
        pair = np.arange(lo, min(lo + CANDIDATES, int(ends[-1])))
        text = np.searchsorted(ends, pair, "right")
        q = pair - (ends - periods)[text] + 1
        grid = np.maximum(SHORTEST - q, 2 * q)
        start, counts = first[texts][text], (sizes[texts][text] - q - 1) // grid + 1
        total = np.cumsum(counts)
        at = 0
        while at < len(pair):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + CANDIDATES, "right")))
            own = np.repeat(np.arange(at, to), counts[at:to])
            nth = np.arange(len(own)) - np.repeat(total[at:to] - counts[at:to] - (total[at - 1] if at else 0), counts[at:to])
            place, span = start[own] + nth * grid[own], q[own]
            hit = words[place] == words[place + span]
            places.append(place[hit])
            spans.append(span[hit])
            at = to
    return np.concatenate(places), np.concatenate(spans)


def find(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start (in the text), length and period of every run, by text, start and period.

    ``words``: word numbers of all texts; text d owns words first[d]:first[d + 1].
    """
    n = len(first) - 1
    # A separator stands before every text and one at the end: symbols 0 to n.
    sequence = np.insert(words.astype(np.int64) + n + 1, first, np.arange(n + 1))
    place, q = candidates(sequence, first[:-1] + np.arange(n) + 1, np.diff(first))
    if not len(place):
        return place, place, place, place
    grammar = Grammar(sequence, n + 1)
    back = grammar.extensions(place - 1, place + q - 1, back=True)
    length = back + q + grammar.extensions(place, place + q)
    start = place - back
    long = length >= np.maximum(SHORTEST, 3 * q)
    start, length, q = start[long], length[long], q[long]
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    new = np.concatenate([[True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])])[:len(start)]
    start, length, q = start[new], length[new], q[new]
    order = np.lexsort((q, start))
    start, length, q = start[order], length[order], q[order]
    text = np.searchsorted(first[:-1] + np.arange(n) + 1, start, "right") - 1
    return text, start - first[text] - text - 1, length, q


def collapsed(words: pa.Array, first: np.ndarray, text: np.ndarray, start: np.ndarray, length: np.ndarray,
              period: np.ndarray) -> pa.Array:
    """Texts without the words that a run holds after its first period, joined by one space."""
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, first[text] + start + period, 1)
    np.add.at(depth, first[text] + start + length, -1)
    kept = np.cumsum(depth)[:-1] == 0
    offsets = np.concatenate([[0], np.cumsum(kept)])[first]
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), words.filter(pa.array(kept)))
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string()))


def runs(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id, ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``."""
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_words long, runs {RUNS}, collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            words, first = split(batch.column("text"))
            numbers = words.dictionary_encode().indices.to_numpy()
            text, start, length, period = find(numbers, first)
            found = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)],
                                               names=["start", "length", "period"])
            offsets = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(first), pa.int64()), pa.ListArray.from_arrays(offsets, found),
                 collapsed(words, first, text, start, length, period).cast(pa.string())],
                ["id", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def greatest(found: Column) -> Column:
    """Of an array of runs in order, the first one of greatest exact length / period; null of none."""
    kind = "struct<start:bigint,length:bigint,period:bigint>"
    return F.aggregate(found, F.lit(None).cast(kind), lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def listing(found: Column) -> Column:
    """A line ``start,length,period`` for every run, each ended by a line feed."""
    lines = F.transform(found, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                  F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return F.array_join(lines, "")


def repeated(text: Column, start: Column, period: Column) -> Column:
    """The text's words joined by one space, those from ``start`` on (numbered from 0) replaced by
    repetitions of the ``period`` words found there."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    rest = F.size(words) - start
    whole = F.call_function("div", rest.cast("long"), period.cast("long")).cast("int")
    return F.array_join(F.concat(
        F.slice(words, F.lit(1), start), F.flatten(F.array_repeat(F.slice(words, start + 1, period), whole)),
        F.slice(words, start + 1, F.pmod(rest, period).cast("int"))), " ")
