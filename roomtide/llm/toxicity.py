"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is the sum of a word embedding and of character embeddings (its first 3, 4, 5 and 6
bytes and its last 3, as hashed n-grams), so unseen forms of a known stem are recognised.  Two gated
recurrent layers read a window of words in both directions, attention weighs the states, and a
logistic unit scores the pooled state.  Every text is cut into overlapping windows that cover all
its words; a text's score is that of its worst window.

Learning is by multiple instances: a labelled text is its windows, and the worst ones by the
present model, of clean and toxic texts alike, carry the label.  The network is fitted on a bounded
sample (``per_class`` distinct texts of each label by lowest hash of id and text, of at most
``characters``); labels meet ids and hashes only, and no text is shuffled.

Defined results: null and empty texts score 0; without both labels every text scores 0; several
labels of a document count as toxic if one does; labels without a document are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomtide.llm import samples
from roomtide.llm.words import Hasher, Words, mixed, slices, words_of

LENGTH = 40
STRIDE = 30
WORDS = 1 << 13
GRAMS = 1 << 13
WIDTH = 12
HIDDEN = 8
CUTS = ((3, False), (4, False), (5, False), (6, False), (3, True))
THRESHOLD = 0.7
SLICE = 1 << 20


def inputs(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of a batch as rows (word slot, character slots), and each word's row.

    The last row stands for padding.
    """
    distinct, first, row = np.unique(found.hashes, return_index=True, return_inverse=True)
    starts, ends = found.starts[first], found.ends[first]
    slots = np.empty((len(distinct) + 1, 1 + len(CUTS)), np.int64)
    slots[-1] = 0
    slots[:-1, 0] = distinct % np.uint64(WORDS)
    data = np.concatenate([found.data, np.zeros(8, np.uint8)])
    for k, (n, tail) in enumerate(CUTS, 1):
        begin = np.maximum(ends - n, starts) if tail else starts
        code = np.full(len(distinct), k, np.uint64)
        for i in range(n):
            byte = np.where(begin + i < ends, data[np.minimum(begin + i, len(data) - 1)], 0)
            code = code * np.uint64(257) + byte.astype(np.uint64)
        slots[:-1, k] = mixed(code) % np.uint64(GRAMS)
    return slots, row.ravel()


def windows(first: np.ndarray, row: np.ndarray, padding: int) -> tuple[np.ndarray, np.ndarray]:
    """Window matrix of input rows, and the text that each window belongs to; empty texts have none."""
    sizes = np.diff(first)
    counts = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - LENGTH) // STRIDE)), 0)
    text = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (first[text] + nth * STRIDE)[:, None] + np.arange(LENGTH)
    inside = at < first[text + 1][:, None]
    return np.where(inside, row[np.minimum(at, max(len(row) - 1, 0))] if len(row) else padding, padding), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters in ``p``; all arrays are float32."""

    def __init__(self, seed: int = 7, parameters: dict[str, np.ndarray] | None = None) -> None:
        if parameters is not None:
            self.p = parameters
            return
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        h = HIDDEN
        self.p = {"word": normal(WORDS, WIDTH, scale=0.05), "gram": normal(GRAMS, WIDTH, scale=0.05)}
        for side in "fb":
            self.p |= {f"w{side}": normal(WIDTH, 3 * h, scale=0.4), f"u{side}": normal(h, 3 * h, scale=0.3),
                       f"c{side}": np.zeros(3 * h, np.float32)}
        self.p |= {"a": normal(2 * h, h, scale=0.4), "v": normal(h, scale=0.4),
                   "o": normal(2 * h, scale=0.4), "b": np.full(1, -1, np.float32)}

    def embedded(self, slots: np.ndarray) -> np.ndarray:
        out = self.p["word"][slots[:, 0]] + self.p["gram"][slots[:, 1:]].sum(1)
        out[-1] = 0
        return out

    def _layer(self, side: str, x: np.ndarray, rows: np.ndarray, real: np.ndarray, keep: bool):
        """States of one direction; ``x`` holds the input gates of distinct words."""
        h, u, n = HIDDEN, self.p[f"u{side}"], len(rows)
        state = np.zeros((n, h), np.float32)
        states = np.zeros((LENGTH, n, h), np.float32)
        saved = []
        for t in range(LENGTH) if side == "f" else range(LENGTH - 1, -1, -1):
            gates = x[rows[:, t]]
            mixed_in = state @ u
            zr = _sigmoid(gates[:, :2 * h] + mixed_in[:, :2 * h])
            z, r = zr[:, :h], zr[:, h:]
            c = np.tanh(gates[:, 2 * h:] + r * mixed_in[:, 2 * h:])
            moved = z * (c - state) * real[:, t, None]
            if keep:
                saved.append((t, state, z, r, c, mixed_in[:, 2 * h:]))
            state = state + moved
            states[t] = state
        return states, saved

    def logits(self, slots: np.ndarray, rows: np.ndarray, size: int = 2048) -> np.ndarray:
        """Of many windows, a few at a time; input gates are computed once per distinct word."""
        gates = self.gates(self.embedded(slots))
        return np.concatenate([self.forward(slots, rows[i:i + size], gates=gates) for i in range(0, len(rows), size)])

    def gates(self, e: np.ndarray) -> dict[str, np.ndarray]:
        return {side: e @ self.p[f"w{side}"] + self.p[f"c{side}"] for side in "fb"}

    def forward(self, slots: np.ndarray, rows: np.ndarray, keep: bool = False, gates: dict | None = None):
        """Logit of every window (rows of input row numbers)."""
        e = self.embedded(slots) if gates is None else None
        gates = self.gates(e) if gates is None else gates
        real = rows != len(slots) - 1
        parts, saved = [], {}
        for side in "fb":
            states, saved[side] = self._layer(side, gates[side], rows, real, keep)
            parts.append(states)
        s = np.concatenate(parts, 2)
        q = np.tanh(s @ self.p["a"])
        score = np.where(real.T, q @ self.p["v"], -1e9)
        weight = np.exp(score - score.max(0))
        weight /= weight.sum(0)
        pooled = (weight[:, :, None] * s).sum(0)
        logit = pooled @ self.p["o"] + self.p["b"][0]
        return (logit, (e, real, saved, s, q, weight, pooled)) if keep else logit

    def gradient(self, slots: np.ndarray, rows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss; only words of these windows are touched."""
        h = HIDDEN
        used, at = np.unique(np.append(rows.ravel(), len(slots) - 1), return_inverse=True)
        slots, rows = slots[used], at.ravel()[:-1].reshape(rows.shape)
        logit, (e, real, saved, s, q, weight, pooled) = self.forward(slots, rows, True)
        d = ((_sigmoid(logit) - labels) / len(rows)).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["o"], g["b"][0] = pooled.T @ d, d.sum()
        dpool = d[:, None] * self.p["o"]
        dweight = (s * dpool).sum(2)
        dscore = weight * (dweight - (weight * dweight).sum(0))
        ds = weight[:, :, None] * dpool
        g["v"] = np.einsum("tnk,tn->k", q, dscore)
        dq = dscore[:, :, None] * self.p["v"] * (1 - q * q)
        g["a"] = np.einsum("tni,tnk->ik", s, dq)
        ds += dq @ self.p["a"].T
        de = np.zeros_like(e)
        for k, side in enumerate("fb"):
            u, w = self.p[f"u{side}"], self.p[f"w{side}"]
            carry = np.zeros((len(rows), h), np.float32)
            for t, state, z, r, c, mc in reversed(saved[side]):
                carry = carry + ds[t][:, k * h:(k + 1) * h]
                live = carry * real[:, t, None]
                dz = live * (c - state) * z * (1 - z)
                dc = live * z * (1 - c * c)
                dr = dc * mc * r * (1 - r)
                gates = np.concatenate([dz, dr, dc], 1)
                back = np.concatenate([dz, dr, dc * r], 1)
                g[f"u{side}"] += state.T @ back
                g[f"c{side}"] += gates.sum(0)
                at = rows[:, t]
                g[f"w{side}"] += e[at].T @ gates
                np.add.at(de, at, gates @ w.T)
                carry = carry - live * z + back @ u.T
        de[-1] = 0
        np.add.at(g["word"], slots[:, 0], de)
        for k in range(1, slots.shape[1]):
            np.add.at(g["gram"], slots[:, k], de)
        return g

    def fit(self, texts: list[str], labels: list[int], rounds: int = 4, steps: int = 20, batch: int = 256) -> None:
        """Alternate between picking each text's worst windows and Adam steps on those."""
        found = words_of(pa.array(texts, pa.large_string()), Hasher())
        slots, row = inputs(found)
        rows, text = windows(found.first, row, len(slots) - 1)
        y = np.asarray(labels)
        # Start from log odds of slots, so the first choice of windows is a sensible one.
        usual: dict[str, np.ndarray] = {}
        owner = np.repeat(np.arange(len(texts)), np.diff(found.first))
        for name, size, column in (("word", WORDS, [0]), ("gram", GRAMS, range(1, slots.shape[1]))):
            seen = np.zeros((2, size))
            for c in column:
                slot, of = np.divmod(np.unique(slots[row, c] * len(texts) + owner), len(texts))
                for label in (0, 1):
                    seen[label] += np.bincount(slot[y[of] == label], minlength=size)
            share = (seen + 0.5) / (np.bincount(y, minlength=2)[:, None] + 1)
            total = seen.sum(0)
            # Slots whose shares differ by chance alone count nothing (pooled z score of 2 to 4).
            size_of = np.bincount(y, minlength=2)
            pooled = np.clip(total / len(y), 1e-9, 1 - 1e-9)
            z = np.abs(seen[1] / size_of[1] - seen[0] / size_of[0]) / np.sqrt(pooled * (1 - pooled) * (1 / size_of).sum())
            odds = np.clip(np.log(share[1] / share[0]), -3, 3) * np.clip((z - 2) / 2, 0, 1)
            # Slots of fewer than three texts are left at zero: they could only be learned by heart.
            usual[name] = (total >= 3).astype(np.float32)[:, None]
            self.p[name][:, 0] += odds.astype(np.float32) / 3
            self.p[name] *= usual[name]
        rng = np.random.default_rng(11)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for turn in range(rounds):
            odds = (self.embedded(slots)[:, 0][rows].max(1) if turn == 0 else
                    self.logits(slots, rows))
            order = np.lexsort((-odds, text))
            rank = np.arange(len(order)) - np.searchsorted(text[order], text[order])
            # The worst window of a toxic text; the three worst of a clean one.
            chosen = order[(rank == 0) | ((rank < 3) & (y[text[order]] == 0))]
            half = [chosen[y[text[chosen]] == label] for label in (0, 1)]
            for _ in range(steps):
                pick = np.concatenate([rng.choice(own, batch // 2) for own in half])
                g = self.gradient(slots, rows[pick], y[text[pick]])
                step += 1
                rate = 0.02 * min(1, step / 10) * (0.96 ** max(0, step - 40))
                for name, mask in usual.items():
                    g[name] *= mask
                for k, v in self.p.items():
                    first[k] = 0.9 * first[k] + 0.1 * g[k]
                    second[k] = 0.99 * second[k] + 0.01 * g[k] ** 2
                    # Embeddings move slowly: the context of a mark must not be learned by heart.
                    v -= (0.03 if k in usual else 1) * rate * (first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6) + 1e-4 * v).astype(np.float32)


def train(documents: DataFrame, labels: DataFrame, per_class: int = 1500, characters: int = 20_000) -> Network | None:
    """Network fitted on a bounded sample; None without texts of both labels."""
    marked = labels.where(F.col("toxic").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max("toxic").cast("int").alias("label"))
    known = documents.where(F.length("text") <= characters).where(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]"))).select(
        F.col("doc_id").alias("id"), F.xxhash64("doc_id", "text").alias("hash"), "text")
    # Labels meet ids and hashes; only texts of the chosen rows are read again.
    chosen = samples.lowest(known.select("id", "hash").join(marked, "id").where(F.col("label").isin(0, 1)), per_class)
    sample = samples.texts_of(known, chosen)
    if len({label for _, label, _ in sample}) < 2:
        return None
    network = Network()
    network.fit([text for _, _, text in sample], [label for _, label, _ in sample])
    return network


def score(documents: DataFrame, network: Network | None) -> DataFrame:
    """All columns plus ``score`` (worst window) and ``windows`` (their number)."""
    shared = documents.sparkSession.sparkContext.broadcast(None if network is None else network.p)  # under 1 MB
    kept = [c for c in documents.columns if c not in ("score", "windows")]
    schema = documents.select(*kept).schema.add("score", "double").add("windows", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = None if shared.value is None else Network(parameters=shared.value)
        hasher = Hasher()
        for batch in slices(batches, "text", SLICE):
            found = words_of(batch.column("text"), hasher)
            out, number = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            if network is not None and len(found.hashes):
                slots, row = inputs(found)
                rows, text = windows(found.first, row, len(slots) - 1)
                logits = network.logits(slots, rows)
                np.maximum.at(out, text, _sigmoid(logits.astype(np.float64)))
                number += np.bincount(text, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(out), pa.array(number)], [*kept, "score", "windows"])

    return documents.select(*kept).mapInArrow(run, schema)


def classify(documents: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """Learn from documents that are not held out, score all; adds score, windows, predicted."""
    network = train(documents.where(~held_out), labels)
    return score(documents, network).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
