"""Language identification with string kernels: blended-spectrum presence, Nystrom, kernel ridge.

A text is the set of its character n-grams of every length 1 to 4.  The kernel of two texts is the
number of n-grams present in both, divided by the geometric mean of their set sizes.  Landmark
texts give Nystrom features; one ridge regression per language on those features says how much a
text belongs to it.  Only n-grams that occur in a landmark can count, so sets are kept over the
landmarks' n-grams, a dictionary fixed by the sample.

Both steps are linear in the (normalized) presence vector.  Scoring therefore folds landmarks and
regression into one matrix with a column per language and multiplies batches of presence rows by
it.  A text is scored in blocks of 2,000 characters, all of them, and a text's scores are the means
over its characters, so a passage in another language counts by its length.

Defined results: a null text or one without a letter is ``und`` with score 0; a text whose n-grams
are all unknown gets the language of the largest intercept; rows without a language or text are
not learned from; without any learned language every text is ``und``; ties go to the smaller name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomtide.llm import samples

LENGTHS = (1, 2, 3, 4)
SLOTS = 1 << 20
BLOCK = 2000


def _grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Slot of every n-gram of code points."""
    m = len(codes) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    out = np.full(m, n, np.uint64)
    for k in range(n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += codes[k:k + m]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return (out >> np.uint64(44)).astype(np.int64)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)


def blocks(text: str) -> list[str]:
    """Pieces of BLOCK characters; a piece repeats the last three before it, so no n-gram is lost."""
    return [text[max(0, at - max(LENGTHS) + 1):at + BLOCK] for at in range(0, max(len(text), 1), BLOCK)]


def presence(texts: list[str], index: np.ndarray, width: int) -> np.ndarray:
    """Boolean row per text: which dictionary n-grams occur.  ``index``: slot -> column or width."""
    out = np.zeros((len(texts), width + 1), bool)
    for row, text in zip(out, texts):
        codes = _codes(text)
        for n in LENGTHS:
            row[index[_grams(codes, n)]] = True
    return out[:, :width]


class Model:
    """Folded classifier: names, slot index, one matrix and intercepts."""

    def __init__(self, texts: list[str], names: list[str], landmarks: int = 256, ridge: float = 1e-3) -> None:
        self.names = sorted(set(names))
        slots: list[np.ndarray] = []
        marks = list(range(0, len(texts), max(1, len(texts) // landmarks)))[:landmarks] if texts else []
        for i in marks:
            codes = _codes(texts[i])
            slots += [np.unique(_grams(codes, n)) for n in LENGTHS]
        known, counts = np.unique(np.concatenate(slots), return_counts=True) if slots else (np.zeros(0, int), 0)
        self.index = np.full(SLOTS, len(known), np.int32)
        self.index[known] = np.arange(len(known))
        self.width = len(known)
        if not self.names:
            self.matrix, self.bias = np.zeros((self.width, 0), np.float32), np.zeros(0)
            return
        marked = self._rows([texts[i] for i in marks])
        kernel = marked @ marked.T
        values, vectors = np.linalg.eigh(kernel)
        keep = values > 1e-6 * values[-1]
        root = vectors[:, keep] / np.sqrt(values[keep])
        features = np.concatenate([self._rows(texts[i:i + 256]) @ marked.T @ root for i in range(0, len(texts), 256)])
        wanted = np.array([[1.0 if a == b else -1.0 for b in self.names] for a in names])
        weight = np.array([1 / names.count(a) for a in names]) * len(names) / len(self.names)
        mean = np.average(features, axis=0, weights=weight)
        centre = np.average(wanted, axis=0, weights=weight)
        x = features - mean
        solved = np.linalg.solve((x * weight[:, None]).T @ x + ridge * len(x) * np.eye(x.shape[1]),
                                 (x * weight[:, None]).T @ (wanted - centre))
        self.matrix = (marked.T @ root @ solved).astype(np.float32)
        self.bias = centre - mean @ solved

    @classmethod
    def of(cls, parts: dict) -> Model:
        """From the attributes of a fitted model, as tasks receive them."""
        out = cls.__new__(cls)
        vars(out).update(parts)
        return out

    def _rows(self, texts: list[str]) -> np.ndarray:
        bits = presence(texts, self.index, self.width)
        size = np.sqrt(np.maximum(bits.sum(1, keepdims=True), 1))
        return bits.astype(np.float32) / size.astype(np.float32)

    def scores(self, texts: list[str]) -> np.ndarray:
        """A row per text, a column per language."""
        pieces = [blocks(t) for t in texts]
        flat = [p for own in pieces for p in own]
        values = np.concatenate([self._rows(flat[i:i + 128]) @ self.matrix for i in range(0, len(flat), 128)])
        weights = np.array([max(len(p), 1) for p in flat], float)
        first = np.cumsum([0, *(len(own) for own in pieces[:-1])])
        return (np.add.reduceat(values * weights[:, None], first)
                / np.add.reduceat(weights, first)[:, None] + self.bias)


def train(rows: DataFrame, per_language: int = 400, characters: int = 20_000) -> Model:
    """Fit on a bounded sample: ``per_language`` texts of each language by lowest hash of id and
    text, among texts of at most ``characters``, so the sample's size in memory is bounded too.

    ``rows``: doc_id, text, lang.
    """
    fit = rows.where(F.col("lang").isNotNull() & (F.length("text") <= characters)).select(
        F.col("lang").alias("label"), F.xxhash64("doc_id", "text", "lang").alias("hash"), "text")
    sample = samples.texts_of(fit, samples.lowest(fit, per_language))
    return Model([t for _, _, t in sample], [a for _, a, _ in sample])


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every document; the text is the only input."""
    shared = documents.sparkSession.sparkContext.broadcast(vars(model))
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        model = Model.of(shared.value)
        letter = regex.compile(r"\p{L}").search
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [t or "" for t in part.column("text").to_pylist()]
                names, scores = ["und"] * len(texts), np.zeros(len(texts))
                if model.names:
                    values = model.scores(texts)
                    best = values.argmax(1)
                    odds = np.exp(4 * (values - values.max(1, keepdims=True)))
                    odds = odds.max(1) / odds.sum(1)
                    for i, text in enumerate(texts):
                        if letter(text):
                            names[i], scores[i] = model.names[best[i]], odds[i]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {id_type}, lang_pred string, score double")


def identify(documents: DataFrame, held_out: Column) -> DataFrame:
    """Train on rows that are not held out, predict all."""
    model = train(documents.where(~held_out).select("doc_id", "text", "lang"))
    return predict(documents, model)
