"""Hidden Markov language model over word classes, trained by Baum-Welch on the whole corpus.

A word that makes up 1 / COMMON of the training tokens or more is a class of its own (so there are
at most COMMON such classes); other words are classed by their last three bytes.  States emit
classes, a class emits its words by their smoothed corpus counts, so the probability of a text is
that of its class sequence times that of each word in its class:

    P(text) = P_hmm(classes) * prod (c + 0.1) / S(class),   S(class) = sum of c + 0.1 over its words,

with one more 0.1 in classes of rare words for all unknown ones.  Every text ends with one end
token.  Counts c, classes, and the expected counts of every Baum-Welch round come from all training
texts: tasks compute them, Spark adds them up, and the driver sees sums of fixed size.  Counts of
rare words are matched by hash range in tasks that hold a few million words each, so no vocabulary
is broadcast or collected.

States start from the class counts of texts that hold one of the ANCHORS most frequent classes, those
that differ most; all training texts count.  Training runs over segments of SEGMENT tokens; scoring runs the scaled forward recursion over whole
texts, which gives their exact likelihood under the model.

Defined results: null and empty texts have the end token only; without training texts the base
score is used (a single unknown token of probability one); equal rows are counted as often as they
occur; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomtide.llm.jaccard import _runs
from roomtide.llm.words import Hasher, mixed, slices, words_of
from roomtide.runtime import stage

STATES = 6
COMMON = 4096
RARE = 512
SEGMENT = 128
ROUNDS = 3
ANCHORS = 48
SMOOTH = 0.1
RANGE_WORDS = 8 << 20
TEXT_BYTES = 6 << 20


class Classes:
    """Class numbers: 0 the end token, then common words in hash order, then rare words' endings."""

    def __init__(self, common: np.ndarray) -> None:
        self.common = np.sort(common)
        self.number = 1 + len(common) + RARE

    def of(self, found) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes, their classes, whether they are rare, and each word's place among them."""
        distinct, first, place = np.unique(found.hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.common, distinct)
        usual = np.zeros(len(distinct), bool)
        if len(self.common):
            usual = self.common[np.minimum(at, len(self.common) - 1)] == distinct
        code = np.zeros(len(distinct), np.uint64)
        starts, ends = found.starts[first], found.ends[first]
        for i in (1, 2, 3):
            byte = np.where(ends - i >= starts, found.data[np.maximum(ends - i, 0)] if len(found.data) else 0, 0)
            code = code * np.uint64(257) + byte.astype(np.uint64)
        ending = (mixed(code) % np.uint64(RARE)).astype(np.int64)
        return distinct, np.where(usual, 1 + at, 1 + len(self.common) + ending), ~usual, place.ravel()


def _read(batches: Iterator[pa.RecordBatch]):
    hasher = Hasher()
    for batch in slices(batches, "text", TEXT_BYTES):
        yield batch, words_of(batch.column("text"), hasher)


def _prepared(documents: DataFrame, held_out: Column) -> DataFrame:
    text = F.col("text").cast("string")
    return documents.select("doc_id", text.alias("text"), held_out.alias("held_out"), F.xxhash64("doc_id", text).alias("key"))


def common_words(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Hashes of at most COMMON words, each 1 / COMMON of the training tokens or more, and the
    number of training tokens; all words are counted, so neither depends on how rows fall into tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _read(batches):
            words, counts = np.unique(found.hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(words.view(np.int64), 0)), pa.array(np.append(counts, len(found.hashes) + batch.num_rows)),
                 pa.array(np.append(np.zeros(len(words), bool), True))], ["word", "count", "total"])

    counted = texts.where(~F.col("held_out")).mapInArrow(run, "word long, count long, total boolean").groupBy("total", "word").agg(
        F.sum("count").alias("count"))
    counted = stage(counted)
    total = counted.where("total").select("count").first()
    tokens = total[0] if total else 0
    rows = counted.where(~F.col("total") & (F.col("count") * COMMON >= tokens)).select("word").collect()
    return np.array([r[0] for r in rows], np.int64).view(np.uint64), tokens


def sequences(texts: DataFrame, classes: Classes) -> DataFrame:
    """key, doc_id, held_out, classes (16-bit numbers as binary) of every text."""
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _read(batches):
            _, number, _, place = classes.of(found)
            tokens = number[place].astype(np.uint16)
            end = np.zeros(1, np.uint16).tobytes()
            packed = [tokens[a:b].tobytes() + end for a, b in zip(found.first[:-1], found.first[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"), batch.column("held_out"), pa.array(packed, pa.binary())],
                ["key", "doc_id", "held_out", "classes"])

    return texts.mapInArrow(run, f"key long, doc_id {kind}, held_out boolean, classes binary")


def rare_counts(texts: DataFrame, classes: Classes, ranges: int) -> DataFrame:
    """what 0: key, log10 sum and number of known tokens over a text's rare words in one range;
    what 1: class, sum of c + 0.1 and number of its known rare words in one range."""
    shift = np.uint64(64 - (ranges.bit_length() - 1))
    offset = 1 + len(classes.common)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _read(batches):
            distinct, number, rare, place = classes.of(found)
            if not rare.any():
                continue
            row = np.repeat(np.arange(batch.num_rows), np.diff(found.first))
            keep = rare[place]
            pairs, counts = np.unique(place[keep].astype(np.int64) * batch.num_rows + row[keep], return_counts=True)
            word, row = pairs // batch.num_rows, pairs % batch.num_rows
            keys = np.asarray(batch.column("key"))
            learned = ~np.asarray(batch.column("held_out").to_numpy(zero_copy_only=False), bool)
            # Distinct words stand in hash order, so a range is a slice.
            bounds = np.searchsorted((distinct >> shift)[word] if ranges > 1 else np.zeros(len(word), np.uint64),
                                     np.arange(ranges + 1, dtype=np.uint64))
            out: list[list] = [[], [], [], [], [], []]
            for r in range(ranges):
                a, b = bounds[r], bounds[r + 1]
                if a == b:
                    continue
                # Keys of the rows that have words here, and no others: their bytes do not grow with the ranges.
                held, at = np.unique(row[a:b], return_inverse=True)
                # A word in several rows is written once.
                word_start = np.flatnonzero(np.concatenate([[True], word[a + 1:b] != word[a:b - 1]]))
                each = np.diff(np.append(word_start, b - a))
                own = word[a:b][word_start]
                for column, value in zip(out, (
                        r, distinct[own].tobytes(), (number[own] - offset).astype(np.uint16).tobytes() + each.astype(np.uint32).tobytes(),
                        at.ravel().astype(np.uint32).tobytes(), counts[a:b].astype(np.uint32).tobytes(),
                        keys[held].tobytes() + learned[held].tobytes())):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int32())] + [pa.array(c, pa.binary()) for c in out[1:]],
                ["range", "words", "classes", "rows", "counts", "keys"])

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches, "range"):
            each = [np.frombuffer(r["classes"], np.uint32, offset=len(r["words"]) // 4) for r in rows]
            words = np.concatenate([np.repeat(np.frombuffer(r["words"], np.uint64), n) for r, n in zip(rows, each)])
            number = np.concatenate([np.repeat(np.frombuffer(r["classes"], np.uint16, len(n)), n) for r, n in zip(rows, each)])
            counts = np.concatenate([np.frombuffer(r["counts"], np.uint32) for r in rows]).astype(np.int64)
            sizes = [len(r["keys"]) // 9 for r in rows]
            shifts = np.cumsum([0, *sizes[:-1]])
            row = np.concatenate([np.frombuffer(r["rows"], np.uint32).astype(np.int64) + s for r, s in zip(rows, shifts)])
            keys = np.concatenate([np.frombuffer(r["keys"][:8 * n], np.int64) for r, n in zip(rows, sizes)])
            learned = np.concatenate([np.frombuffer(r["keys"][8 * n:], bool) for r, n in zip(rows, sizes)])
            _, first, place = np.unique(words, return_index=True, return_inverse=True)
            c = np.bincount(place, weights=counts * learned[row])
            value = counts * np.log10(c + SMOOTH)[place]
            total = np.bincount(row, weights=value, minlength=len(keys))
            known = np.bincount(row, weights=counts * (c > 0)[place], minlength=len(keys))
            some = np.flatnonzero(np.bincount(row, minlength=len(keys)))
            yield made(0, keys[some], total[some], known[some])
            real = c > 0
            mass = np.bincount(number[first][real], weights=c[real] + SMOOTH, minlength=RARE)
            words_of_class = np.bincount(number[first][real], minlength=RARE)
            yield made(1, np.arange(RARE), mass, words_of_class)

    def made(what: int, key: np.ndarray, value: np.ndarray, known: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(key), what, np.int32)), pa.array(key.astype(np.int64)), pa.array(value.astype(np.float64)),
             pa.array(known.astype(np.int64))], ["what", "key", "value", "known"])

    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), ranges)
    return texts.mapInArrow(packed, "range int, words binary, classes binary, rows binary, counts binary, keys binary").repartition(
        parts, "range").sortWithinPartitions("range").mapInArrow(matched, "what int, key long, value double, known long")


class Model:
    """start (K), move (K, K), emit (K, C); rows sum to one."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def started(cls, seen: np.ndarray, totals: np.ndarray) -> Model:
        """From ``seen``, a row of class counts of the texts that hold each anchor class: states
        start from anchors whose texts differ most, chosen farthest first."""
        usual = (totals + 0.5) / (totals + 0.5).sum()
        emit = np.tile(usual, (STATES, 1))
        if len(seen):
            rows = seen + 30 * usual
            rows /= rows.sum(1, keepdims=True)
            roots = np.sqrt(rows)
            chosen = [int(((roots - np.sqrt(usual)) ** 2).sum(1).argmax())]
            while len(chosen) < STATES:
                gap = np.min([((roots - roots[k]) ** 2).sum(1) for k in chosen], axis=0)
                chosen.append(int(gap.argmax()))
            emit = rows[chosen]
        move = np.full((STATES, STATES), 0.05 / max(STATES - 1, 1))
        np.fill_diagonal(move, 0.95)
        return cls(np.full(STATES, 1 / STATES), move, emit)

    def expected(self, tokens: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Flat expected counts (starts, moves, emissions) of sequences of up to SEGMENT tokens."""
        order = np.argsort(-sizes, kind="stable")
        begin, sizes = begin[order], sizes[order]
        steps = int(sizes[0]) if len(sizes) else 0
        live = [int(np.searchsorted(-sizes, -t, "left")) for t in range(steps)]
        emit = np.ascontiguousarray(self.emit.T)
        starts, moves, emits = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, self.emit.shape[1]))
        alphas, bs, scales, ids = [], [], [], []
        for t in range(steps):
            n = live[t]
            now = tokens[begin[:n] + t]
            b = emit[now]
            a = (self.start if t == 0 else alphas[-1][:n] @ self.move) * b
            scale = a.sum(1, keepdims=True)
            alphas.append(a / scale)
            bs.append(b / scale)
            ids.append(now)
        beta = np.ones((live[-1] if steps else 0, STATES))
        for t in range(steps - 1, -1, -1):
            n = live[t]
            if len(beta) < n:
                beta = np.concatenate([beta, np.ones((n - len(beta), STATES))])
            gamma = alphas[t] * beta
            for k in range(STATES):
                emits[k] += np.bincount(ids[t], weights=gamma[:, k], minlength=emits.shape[1])
            if t == 0:
                starts += gamma.sum(0)
            else:
                back = bs[t] * beta
                moves += alphas[t - 1][:n].T @ back
                beta = back @ self.move.T
        return np.concatenate([starts, (moves * self.move).ravel(), emits.ravel()])

    @classmethod
    def learned(cls, counts: np.ndarray, totals: np.ndarray) -> Model:
        """Maximum of the expected counts, a little smoothed so that every class can be emitted."""
        start = counts[:STATES] + 0.1
        move = counts[STATES:STATES + STATES ** 2].reshape(STATES, STATES) + 0.1
        usual = (totals + 0.5) / (totals + 0.5).sum()
        emit = counts[STATES + STATES ** 2:].reshape(STATES, -1) + 5 * usual
        return cls(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))

    def log10(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Exact log10 probability of each whole sequence by the scaled forward recursion."""
        sizes = np.array([len(s) for s in sequences])
        order = np.argsort(-sizes, kind="stable")
        tokens = np.concatenate(sequences) if sequences else np.zeros(0, np.int64)
        begin = (np.cumsum(sizes) - sizes)[order]
        emit = np.ascontiguousarray(self.emit.T)
        total = np.zeros(len(sizes))
        live = np.searchsorted(-sizes[order], -np.arange(sizes.max(initial=0)), "left")
        a = None
        for t, n in enumerate(live):
            a = (np.broadcast_to(self.start, (n, STATES)) if t == 0 else a[:n] @ self.move) * emit[tokens[begin[:n] + t]]
            scale = a.sum(1)
            total[:n] += np.log10(scale)
            a /= scale[:, None]
        out = np.empty(len(sizes))
        out[order] = total
        return out


def _unpacked(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint16).astype(np.int64) for x in batch.column("classes").to_pylist()]


def train(coded: DataFrame, classes: Classes, rounds: int = ROUNDS, anchors: int = ANCHORS) -> tuple[Model, np.ndarray]:
    """Model and the training count of every class."""
    spark = coded.sparkSession
    learning = coded.where(~F.col("held_out"))
    number = classes.number

    def added(run) -> np.ndarray:
        """Sums over all tasks of the vectors that ``run`` makes; their length is fixed."""
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for at in range(0, batch.num_rows, 1000):
                    now = run(_unpacked(batch.slice(at, 1000)))
                    total = now if total is None else total + now
            if total is not None:
                place = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(total[place])], ["place", "value"])

        summed = learning.select("classes").mapInArrow(rows, "place int, value double").groupBy("place").agg(
            F.sum("value").alias("value")).collect()  # at most one row a parameter
        out = np.zeros(max([r[0] for r in summed], default=0) + 1)
        for place, value in summed:
            out[place] = value
        return out

    totals = added(lambda own: np.bincount(np.concatenate(own), minlength=number).astype(np.float64))
    totals = np.concatenate([totals, np.zeros(number)])[:number]
    anchor = np.argsort(-totals[1:], kind="stable")[:anchors] + 1
    anchor = anchor[totals[anchor] > 0]

    def held(own: list[np.ndarray]) -> np.ndarray:
        """Class counts of the texts that hold each anchor, added up over all texts."""
        sums = np.zeros((len(anchor), number))
        for at in range(0, len(own), 250):
            part = own[at:at + 250]
            text = np.repeat(np.arange(len(part)), [len(s) for s in part])
            tokens = np.concatenate(part)
            counts = np.bincount(text * number + tokens, minlength=len(part) * number).reshape(len(part), number).astype(float)
            sums += (counts[:, anchor] > 0).astype(float).T @ counts
        return sums.ravel()

    seen = np.concatenate([added(held), np.zeros(len(anchor) * number)])[:len(anchor) * number]
    model = Model.started(seen.reshape(len(anchor), number), totals)
    size = STATES + STATES ** 2 + STATES * number
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((model.start, model.move, model.emit))  # states x classes numbers

        def run(own: list[np.ndarray], shared=shared) -> np.ndarray:
            tokens = np.concatenate(own)
            sizes = np.array([len(s) for s in own])
            begin = np.cumsum(sizes) - sizes
            pieces = -(-sizes // SEGMENT)
            start = np.repeat(begin, pieces) + SEGMENT * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
            stop = np.minimum(start + SEGMENT, np.repeat(begin + sizes, pieces))
            out = np.zeros(size)
            for at in range(0, len(start), 4096):
                out += Model(*shared.value).expected(tokens, start[at:at + 4096], (stop - start)[at:at + 4096])
            return out

        counts = np.concatenate([added(run), np.zeros(size)])[:size]
        model = Model.learned(counts, totals)
    return model, totals


def score(documents: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    texts = _prepared(documents, held_out)
    common, tokens = common_words(texts)
    classes = Classes(common)
    coded = stage(sequences(texts, classes))
    ranges = 16
    while ranges * RANGE_WORDS < tokens and ranges < 1 << 16:
        ranges *= 2
    rare = stage(rare_counts(texts, classes, ranges))
    model, totals = train(coded, classes)
    masses = rare.where("what = 1").groupBy("key").agg(F.sum("value"), F.sum("known")).collect()  # RARE rows
    rare_mass, rare_words = np.zeros(RARE), 0
    for key, mass, known in masses:
        rare_mass[key] = mass
        rare_words += int(known)
    offset = 1 + len(common)
    trained = float(totals.sum())
    words = rare_words + int((totals[:offset] > 0).sum())
    scale = np.log10(trained + SMOOTH * (words + 1))
    # Sum over tokens of log10(c + 0.1) of common classes, and of log10 S(class) of all.
    usual = np.concatenate([np.log10(totals[:offset] + SMOOTH), np.zeros(RARE)])
    mass = np.concatenate([np.log10(totals[:offset] + SMOOTH), np.log10(rare_mass + SMOOTH)])
    known = np.concatenate([totals[:offset] > 0, np.zeros(RARE, bool)])
    shared = documents.sparkSession.sparkContext.broadcast(
        ((model.start, model.move, model.emit), usual, mass, known))  # a few numbers a class
    kind = coded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (start, move, emit), usual, mass, known = shared.value
        model = Model(start, move, emit)
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                part = batch.slice(at, 4000)
                own = _unpacked(part)
                flat = np.concatenate(own)
                first = np.cumsum([0, *map(len, own)])[:-1]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("doc_id"), part.column("held_out"),
                     pa.array([len(s) for s in own], pa.int64()), pa.array(np.add.reduceat(known[flat].astype(np.int64), first)),
                     pa.array(np.add.reduceat(usual[flat], first)), pa.array(np.add.reduceat(mass[flat], first)),
                     pa.array(model.log10(own))],
                    ["key", "doc_id", "held_out", "n_tokens", "known", "usual", "mass", "path"])

    walked = coded.mapInArrow(run, f"key long, doc_id {kind}, held_out boolean, n_tokens long, known long, "
                                   "usual double, mass double, path double")
    # Equal rows have one key and add up there, so a row's share is the sum over their number.
    copies = coded.groupBy("key").count()
    sums = rare.where("what = 0").groupBy("key").agg(F.sum("value").alias("value"), F.sum("known").alias("rare_known"))
    sums = sums.join(copies, "key").select("key", (F.col("value") / F.col("count")).alias("value"),
                                           F.round(F.col("rare_known") / F.col("count")).cast("long").alias("rare_known"))
    out = walked.join(sums, "key", "left").na.fill({"value": 0.0, "rare_known": 0})
    logs = F.col("usual") + F.col("value")
    base = logs - F.col("n_tokens") * F.lit(float(scale))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.col("rare_known")).alias("n_known"),
        F.lit(int(trained)).cast("long").alias("train_tokens"), base.alias("base_score"),
        (F.col("path") + logs - F.col("mass") if trained else base).alias("score"))
