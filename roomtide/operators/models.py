"""L1 logistic regression for many training sets at once.

The objective is ``sum(log loss) + |w|_1 / C`` with an unpenalised intercept, minimised by
proximal Newton steps.  Fits of one training set and held-out fold form a chain of strengths,
solved from the strongest penalty down: each starts from the last one's weights, gradient and
Hessian.  Everything happens in the executors.  Training sets of up to ``LOCAL_ROWS`` rows meet
in one task each, which solves batches of them in step: one job for any number of sets.  Larger
sets stay spread out as blocks; a pass over the blocks adds up loss, gradient and Hessian, a
table of chains takes one step, and only whether chains are open reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomtide.runtime import spread, stage
from roomtide.schemas import FEATURES

N_WEIGHTS = len(FEATURES) + 1
UPPER = np.triu_indices(N_WEIGHTS)
NO_HOLDOUT = -1
MAX_PASSES = 5000
#: Rows of a training set that one task solves by itself (about 40 MB).
LOCAL_ROWS = 1 << 18
#: Rows and training sets that a task solves together, and rows of a stored block.
BATCH_ROWS = 1 << 18
BATCH_SETS = 512
BLOCK_ROWS = 4096
FIT_SCHEMA = "dataset STRING, c DOUBLE, holdout INT"
MODEL_SCHEMA = (
    "dataset STRING, c DOUBLE, holdout INT, coef ARRAY<DOUBLE>, passes INT, violation DOUBLE"
)
SOLVED_SCHEMA = f"{MODEL_SCHEMA}, converged BOOLEAN, right_rows LONG, held_rows LONG"


@dataclass(frozen=True)
class Fit:
    """A requested model: training set, strength and the fold left out, if any."""

    dataset: str
    c: float
    holdout: int = NO_HOLDOUT


class NotConverged(RuntimeError):
    """A fit ended its passes, or could not improve, before it was optimal."""


def training_rows(df: DataFrame, dataset: str = "dataset", fold: str | None = None) -> DataFrame:
    """Columns the trainer reads; rows with incomplete lags are left out."""
    fold_column = F.col(fold).cast("int") if fold else F.lit(NO_HOLDOUT)
    return df.select(
        F.col(dataset).cast("string").alias("dataset"),
        fold_column.alias("fold"),
        *[F.col(f).cast("double").alias(f) for f in FEATURES],
        F.col("occupied").cast("double").alias("occupied"),
    ).dropna()


def _sigmoid(score: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(score, -700, 700)))


#: Loss, gradient, upper triangle of the Hessian and rows of a fit, one after the other.
WIDTH = 2 + N_WEIGHTS + len(UPPER[0])


def _derivative_sums(matrix: np.ndarray, label: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums over the rows for every fit (row of ``weights``)."""
    out = np.empty((len(weights), WIDTH))
    score = matrix @ weights.T
    prob = _sigmoid(score)
    out[:, 0] = (np.logaddexp(0.0, score) - label[:, None] * score).sum(axis=0)
    out[:, 1 : 1 + N_WEIGHTS] = (prob - label[:, None]).T @ matrix
    curve = prob * (1.0 - prob)
    for k in range(len(weights)):
        out[k, 1 + N_WEIGHTS : -1] = ((matrix * curve[:, k : k + 1]).T @ matrix)[UPPER]
    out[:, -1] = len(label)
    return out


def _shrink(value: np.ndarray, by: np.ndarray) -> np.ndarray:
    return np.sign(value) * np.maximum(np.abs(value) - by, 0.0)


def _sweep(
    target: np.ndarray, slope: np.ndarray, hessian: np.ndarray, penalty: np.ndarray
) -> None:
    """One round of coordinate descent on the penalised quadratic model, in place."""
    for j in range(N_WEIGHTS):
        curvature = np.maximum(hessian[:, j, j], 1e-12)
        moved = target[:, j] - slope[:, j] / curvature
        if j < N_WEIGHTS - 1:
            moved = _shrink(moved, penalty / curvature)
        change = moved - target[:, j]
        target[:, j] = moved
        slope += change[:, None] * hessian[:, :, j]


def _solve_on_support(
    target: np.ndarray, linear: np.ndarray, hessian: np.ndarray, penalty: np.ndarray
) -> np.ndarray:
    """Exact minimum for the present signs; a weight that would change sign stops at 0."""
    target = target.copy()
    todo = np.arange(len(target))
    for _ in range(N_WEIGHTS):
        here = target[todo]
        free = here != 0
        free[:, -1] = True
        system = hessian[todo] * free[:, :, None] * free[:, None, :]
        system[:, range(N_WEIGHTS), range(N_WEIGHTS)] += ~free
        signs = np.sign(here)
        signs[:, -1] = 0.0
        right = (linear[todo] - penalty[todo, None] * signs) * free
        goal = np.linalg.solve(system, right[:, :, None])[:, :, 0]
        crossing = free & (np.sign(goal) != signs) & (signs != 0)
        share = np.where(crossing, here / np.where(crossing, here - goal, 1.0), 1.0)
        first = share.min(axis=1)
        here = here + first[:, None] * (goal - here)
        here[crossing & (share <= first[:, None])] = 0.0
        target[todo] = here
        todo = todo[crossing.any(axis=1)]
        if not len(todo):
            break
    return target


def _newton_direction(
    gradient: np.ndarray, hessian: np.ndarray, weights: np.ndarray, penalty: np.ndarray
) -> np.ndarray:
    """Minimise the penalised quadratic model of every fit at once."""
    linear = np.einsum("mij,mj->mi", hessian, weights) - gradient
    target = weights.copy()
    todo = np.arange(len(weights))
    for _ in range(100):
        here, h, lam = target[todo], hessian[todo], penalty[todo]
        slope = np.einsum("mij,mj->mi", h, here) - linear[todo]
        for _ in range(3):
            _sweep(here, slope, h, lam)
        here = _solve_on_support(here, linear[todo], h, lam)
        target[todo] = here
        slope = np.einsum("mij,mj->mi", h, here) - linear[todo]
        todo = todo[_violation(slope, here, lam) > 1e-9 * lam]
        if not len(todo):
            break
    return target - weights


def _violation(gradient: np.ndarray, weights: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Largest breach of the optimality conditions per model."""
    inner, w = gradient[:, :-1], weights[:, :-1]
    at_zero = np.maximum(np.abs(inner) - penalty[:, None], 0.0)
    elsewhere = np.abs(inner + penalty[:, None] * np.sign(w))
    breach = np.where(w == 0, at_zero, elsewhere).max(axis=1)
    return np.maximum(breach, np.abs(gradient[:, -1]))


def _shorten(rise: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """Factor for a step that did not pay off, from a parabola through what is known."""
    bend = np.maximum(rise - expected, 1e-300)
    return np.clip(-expected / (2.0 * bend), 0.1, 0.5)


class Solver:
    """Proximal Newton steps for many fits in step, a row of every array per fit.

    The arrays are all the state there is: a pass may be made by another task than the last.
    """

    FIELDS = {
        "penalty": 0, "best": N_WEIGHTS, "value": 0, "direction": N_WEIGHTS, "expected": 0,
        "length": 0, "violation": 0, "passes": 0, "sums": WIDTH,
    }

    def __init__(self, penalty: np.ndarray, tolerance: float, max_passes: int) -> None:
        n = len(penalty)
        self.tolerance, self.max_passes = tolerance, max_passes
        for name, width in self.FIELDS.items():
            setattr(self, name, np.zeros((n, width) if width else n))
        self.penalty[:] = penalty
        self.value[:] = self.violation[:] = np.inf
        self.length[:] = 1.0

    def packed(self) -> np.ndarray:
        return np.column_stack([getattr(self, name) for name in self.FIELDS])

    @classmethod
    def unpacked(cls, packed: np.ndarray, tolerance: float, max_passes: int) -> Solver:
        solver, at = cls(np.zeros(len(packed)), tolerance, max_passes), 0
        for name, width in cls.FIELDS.items():
            part = packed[:, at : at + max(width, 1)]
            getattr(solver, name)[:] = part if width else part[:, 0]
            at += max(width, 1)
        return solver

    def trial(self, ids: np.ndarray) -> np.ndarray:
        return self.best[ids] + self.length[ids, None] * self.direction[ids]

    def _objective(self, loss: np.ndarray, weights: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return loss + self.penalty[ids] * np.abs(weights[:, :-1]).sum(axis=1)

    def take(self, ids: np.ndarray, sums: np.ndarray) -> None:
        """Accept or shorten the step of every fit of ``ids``, given the sums at its trial."""
        trial = self.trial(ids)
        value = self._objective(sums[:, 0], trial, ids)
        self.passes[ids] += 1
        goal = self.value[ids] + 1e-4 * self.length[ids] * self.expected[ids]
        good = value <= goal + 1e-12 * np.abs(value)
        short = ids[~good]
        self.length[short] *= _shorten(
            (value - self.value[ids])[~good], self.length[short] * self.expected[short]
        )
        taken = ids[good]
        self.best[taken], self.value[taken], self.sums[taken] = trial[good], value[good], sums[good]
        self.length[taken] = np.minimum(1.0, 4.0 * self.length[taken])
        self._aim(taken)

    def _aim(self, ids: np.ndarray) -> None:
        """Violation and next direction at the best weights."""
        if not len(ids):
            return
        gradient = self.sums[ids, 1 : 1 + N_WEIGHTS]
        weights, lam = self.best[ids], self.penalty[ids]
        self.violation[ids] = _violation(gradient, weights, lam)
        open_ids = ids[~self.converged(ids)]
        if not len(open_ids):
            return
        gradient, weights = self.sums[open_ids, 1 : 1 + N_WEIGHTS], self.best[open_ids]
        lam = self.penalty[open_ids]
        hessian = np.zeros((len(open_ids), N_WEIGHTS, N_WEIGHTS))
        hessian[:, UPPER[0], UPPER[1]] = self.sums[open_ids, 1 + N_WEIGHTS : -1]
        hessian[:, UPPER[1], UPPER[0]] = self.sums[open_ids, 1 + N_WEIGHTS : -1]
        size = np.maximum(np.einsum("mii->m", hessian), 1.0)
        hessian += (1e-12 * size)[:, None, None] * np.eye(N_WEIGHTS)
        step = _newton_direction(gradient, hessian, weights, lam)
        moved = np.abs(weights + step)[:, :-1].sum(axis=1)
        kept = np.abs(weights)[:, :-1].sum(axis=1)
        self.direction[open_ids] = step
        self.expected[open_ids] = (gradient * step).sum(axis=1) + lam * (moved - kept)

    def converged(self, ids: np.ndarray) -> np.ndarray:
        """Optimal up to the tolerance, relative to the penalty, and to rounding of the sums."""
        return self.violation[ids] <= self.tolerance * self.penalty[ids] + 1e-15 * self.sums[ids, -1]

    def closed(self, ids: np.ndarray) -> np.ndarray:
        """Converged, out of passes, or unable to improve."""
        spent = (self.passes[ids] >= self.max_passes) | (self.length[ids] < 1e-8)
        return self.converged(ids) | spent

    def restart(self, ids: np.ndarray, penalty: np.ndarray) -> None:
        """Go on with another penalty from the present weights; needs no pass over the rows."""
        self.penalty[ids], self.passes[ids], self.length[ids] = penalty, 0, 1.0
        self.value[ids] = self._objective(self.sums[ids, 0], self.best[ids], ids)
        self._aim(ids)


class Chains:
    """Chains of strengths under one solver; ``solved`` collects (chain, c, row of results)."""

    def __init__(self, strengths: Sequence[np.ndarray], solver: Solver, place: np.ndarray) -> None:
        self.strengths, self.solver, self.place = strengths, solver, place
        self.solved: list[tuple] = []

    @classmethod
    def started(cls, strengths: Sequence[np.ndarray], tolerance: float, max_passes: int) -> Chains:
        first = np.array([1.0 / s[0] for s in strengths])
        return cls(strengths, Solver(first, tolerance, max_passes), np.zeros(len(strengths), int))

    def open_ids(self) -> np.ndarray:
        return np.flatnonzero([p < len(s) for p, s in zip(self.place, self.strengths)])

    def take(self, ids: np.ndarray, sums: np.ndarray) -> None:
        """One pass; chains whose fit is closed go on to the next strength."""
        self.solver.take(ids, sums)
        while len(ids):
            ids = ids[self.solver.closed(ids)]
            for i, done in zip(ids.tolist(), self.solver.converged(ids).tolist()):
                self.solved.append((i, float(self.strengths[i][self.place[i]]), self.solver.best[i].copy(),
                                    int(self.solver.passes[i]), float(self.solver.violation[i]), done))
                self.place[i] += 1
            ids = np.array([i for i in ids if self.place[i] < len(self.strengths[i])], int)
            if len(ids):
                self.solver.restart(ids, np.array([1.0 / self.strengths[i][self.place[i]] for i in ids]))


def _matrix(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    values = [batch.column(f).to_numpy() for f in FEATURES]
    return np.column_stack([*values, np.ones(batch.num_rows)])


def _requests(spark, fits: Sequence[Fit] | DataFrame) -> DataFrame:
    if isinstance(fits, DataFrame):
        return fits.select("dataset", "c", "holdout")
    return spark.createDataFrame([(f.dataset, float(f.c), int(f.holdout)) for f in fits], FIT_SCHEMA)


def _as_batch(solved: list[tuple]) -> pa.RecordBatch:
    """Rows of SOLVED_SCHEMA."""
    columns = list(zip(*solved)) if solved else [()] * 9
    kinds = [pa.string(), pa.float64(), pa.int32(), pa.list_(pa.float64()), pa.int32(), pa.float64(),
             pa.bool_(), pa.int64(), pa.int64()]
    names = [c.strip().split(" ")[0] for c in SOLVED_SCHEMA.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


class _Set:
    """One training set in a task: its rows by fold and the strengths asked for by holdout."""

    def __init__(self, name: str, folds: np.ndarray, matrix: np.ndarray, label: np.ndarray, asked: dict) -> None:
        self.name, self.asked = name, asked
        self.blocks = [(f, matrix[folds == f], label[folds == f]) for f in np.unique(folds).tolist()]

    def sums(self, holdouts: np.ndarray, weights: np.ndarray) -> np.ndarray:
        out = np.zeros((len(weights), WIDTH))
        for fold, matrix, label in self.blocks:
            use = (holdouts != fold) | (holdouts == NO_HOLDOUT)
            out[use] += _derivative_sums(matrix, label, weights[use])
        return out

    def held_out(self, holdout: int, weights: np.ndarray) -> tuple[int, int]:
        """Right answers and rows of the fold that a fit left out."""
        for fold, matrix, label in self.blocks:
            if fold == holdout != NO_HOLDOUT:
                return int((((matrix @ weights) > 0) == (label > 0.5)).sum()), len(label)
        return 0, 0


def _solve_sets(sets: list[_Set], tolerance: float, max_passes: int) -> list[tuple]:
    """Rows of SOLVED_SCHEMA for all fits of some sets, whose Newton steps are taken together."""
    chains, owner = [], []
    for number, own in enumerate(sets):
        for holdout, strengths in own.asked.items():
            if any(f != holdout or f == NO_HOLDOUT for f, _, _ in own.blocks):
                chains.append((holdout, np.array(sorted(strengths))))
                owner.append(number)
    if not chains:
        return []
    holdouts, owners = np.array([h for h, _ in chains]), np.array(owner)
    path = Chains.started([s for _, s in chains], tolerance, max_passes)
    while len(ids := path.open_ids()):
        trial, sums = path.solver.trial(ids), np.empty((len(ids), WIDTH))
        for number in np.unique(owners[ids]).tolist():
            mine = owners[ids] == number
            sums[mine] = sets[number].sums(holdouts[ids[mine]], trial[mine])
        path.take(ids, sums)
    return [
        (sets[owners[i]].name, c, int(holdouts[i]), weights.tolist(), passes, violation, done,
         *sets[owners[i]].held_out(int(holdouts[i]), weights))
        for i, c, weights, passes, violation, done in path.solved
    ]


def _solve_small(rows: DataFrame, requests: DataFrame, tolerance: float, max_passes: int) -> DataFrame:
    """All fits of sets that one task can hold, in one job."""
    blank = [F.lit(None).cast("double").alias(f) for f in (*FEATURES, "occupied")]
    asked = requests.select("dataset", F.col("holdout").alias("fold"), *blank, "c")
    both = rows.withColumn("c", F.lit(None).cast("double")).unionByName(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        ready: list[_Set] = []
        held = 0

        def close() -> None:
            """The set read last is complete."""
            nonlocal held
            table = pa.concat_tables(waiting)
            waiting.clear()
            wanted = np.isfinite(table.column("c").to_numpy())
            folds = table.column("fold").to_numpy()
            asked: dict[int, set] = {}
            for holdout, c in zip(folds[wanted].tolist(), table.column("c").to_numpy()[wanted].tolist()):
                asked.setdefault(holdout, set()).add(c)
            own = table.filter(pa.array(~wanted))
            if asked and own.num_rows:
                ready.append(_Set(table.column("dataset")[0].as_py(), folds[~wanted], _matrix(own),
                                  own.column("occupied").to_numpy(), asked))
                held += own.num_rows

        for batch in batches:
            codes = batch.column("dataset").dictionary_encode().indices.to_numpy()
            edges = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(edges[:-1], edges[1:]):
                part = pa.Table.from_batches([batch.slice(lo, hi - lo)])
                if waiting and waiting[-1].column("dataset")[0].as_py() != part.column("dataset")[0].as_py():
                    close()
                    if held >= BATCH_ROWS or len(ready) >= BATCH_SETS:
                        yield _as_batch(_solve_sets(ready, tolerance, max_passes))
                        ready, held = [], 0
                if hi > lo:
                    waiting.append(part)
        if waiting:
            close()
        if ready:
            yield _as_batch(_solve_sets(ready, tolerance, max_passes))

    return spread(both, "dataset").sortWithinPartitions("dataset").mapInArrow(run, SOLVED_SCHEMA)


def _stored_blocks(rows: DataFrame) -> DataFrame:
    """dataset, fold, matrix and label as binary, up to BLOCK_ROWS rows of one fold each; staged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, folds = batch.column("dataset").to_pylist(), batch.column("fold").to_numpy()
            matrix, label = _matrix(batch), batch.column("occupied").to_numpy()
            change = np.array([a != b for a, b in zip(names[1:], names[:-1])], bool)
            edges = [0, *(np.flatnonzero(change | (folds[1:] != folds[:-1])) + 1).tolist(), batch.num_rows]
            for lo, end in zip(edges[:-1], edges[1:]):
                for at in range(lo, end, BLOCK_ROWS):
                    to = min(at + BLOCK_ROWS, end)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[at]]), pa.array([folds[at]], pa.int32()), pa.array([matrix[at:to].tobytes()]),
                         pa.array([label[at:to].tobytes()])], names=["dataset", "fold", "matrix", "label"])

    ordered = rows.sortWithinPartitions("dataset", "fold")
    return stage(ordered.mapInArrow(run, "dataset STRING, fold INT, matrix BINARY, label BINARY"))


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["matrix"]).reshape(-1, N_WEIGHTS), np.frombuffer(row["label"])


def _added(blocks: DataFrame, weights: DataFrame, of_block, width: int) -> DataFrame:
    """dataset, chain and the sums of ``of_block`` over the blocks of every training set.

    ``weights``: dataset, chain, holdout, weights.  Blocks meet the weights of their set, so a
    set of very many blocks can be split over tasks; sums are added up before they are shuffled.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    asked = weights.groupBy("dataset").agg(F.collect_list(F.struct("chain", "holdout", "weights")).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict[tuple, np.ndarray] = {}
            for row in batch.to_pylist():
                ask = row["asked"]
                found = of_block(row["fold"], *_opened(row), np.array([a["holdout"] for a in ask]),
                                 np.array([a["weights"] for a in ask]))
                for a, sums in zip(ask, found):
                    key = (row["dataset"], a["chain"])
                    total[key] = total[key] + sums if key in total else sums
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.string()),
                 pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))], names=["dataset", "chain", "sums"])

    parts = blocks.join(asked, "dataset").mapInArrow(run, "dataset STRING, chain STRING, sums ARRAY<DOUBLE>")
    return parts.groupBy("dataset", "chain").agg(
        vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))


def _block_derivatives(fold, matrix, label, holdouts, weights) -> np.ndarray:
    out = np.zeros((len(weights), WIDTH))
    use = (holdouts != fold) | (holdouts == NO_HOLDOUT)
    out[use] = _derivative_sums(matrix, label, weights[use])
    return out


def _block_answers(fold, matrix, label, holdouts, weights) -> np.ndarray:
    """Right answers and rows of the folds left out."""
    right = (((matrix @ weights.T) > 0) == (label[:, None] > 0.5)).sum(axis=0)
    held = (holdouts == fold) & (holdouts != NO_HOLDOUT)
    return np.column_stack([np.where(held, right, 0), np.where(held, len(label), 0)]).astype(float)


def _solve_large(rows: DataFrame, requests: DataFrame, tolerance: float, max_passes: int) -> DataFrame:
    """All fits of sets that are spread over tasks: a table of chains, a step of each in every pass."""
    blocks = _stored_blocks(rows)
    chain = F.concat_ws("#", "dataset", "holdout").alias("chain")
    # A chain for every set and holdout that has rows; solver is its state, solved its results.
    state_schema = ("dataset STRING, holdout INT, chain STRING, strengths ARRAY<DOUBLE>, place INT, "
                    "trial ARRAY<DOUBLE>, solver ARRAY<DOUBLE>, "
                    "solved ARRAY<STRUCT<c: DOUBLE, coef: ARRAY<DOUBLE>, passes: INT, violation: DOUBLE, converged: BOOLEAN>>")
    folds = blocks.select("dataset", "fold").distinct()
    real = requests.distinct().join(folds, "dataset").where(
        (F.col("fold") != F.col("holdout")) | (F.col("holdout") == NO_HOLDOUT))
    listed = real.groupBy("dataset", "holdout").agg(F.sort_array(F.collect_set("c")).alias("strengths"))

    def opened(batch: pa.RecordBatch) -> Chains | None:
        strengths = [np.array(s) for s in batch.column("strengths").to_pylist()]
        if "solver" not in batch.schema.names:
            return Chains.started(strengths, tolerance, max_passes)
        packed = np.array(batch.column("solver").to_pylist())
        return Chains(strengths, Solver.unpacked(packed, tolerance, max_passes), batch.column("place").to_numpy().copy())

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            path = opened(batch)
            solved = batch.column("solved").to_pylist() if "solved" in batch.schema.names else [[] for _ in range(batch.num_rows)]
            if "sums" in batch.schema.names:
                ids = path.open_ids()
                sums = batch.column("sums").to_pylist()
                path.take(ids, np.array([sums[i] for i in ids]).reshape(len(ids), WIDTH))
            for i, c, weights, passes, violation, done in path.solved:
                solved[i].append({"c": c, "coef": weights.tolist(), "passes": passes, "violation": violation, "converged": done})
            trial = path.solver.trial(np.arange(batch.num_rows))
            kind = pa.list_(pa.struct([("c", pa.float64()), ("coef", pa.list_(pa.float64())), ("passes", pa.int32()),
                                       ("violation", pa.float64()), ("converged", pa.bool_())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("dataset"), batch.column("holdout"), batch.column("chain"), batch.column("strengths"),
                 pa.array(path.place, pa.int32()), pa.array(trial.tolist(), pa.list_(pa.float64())),
                 pa.array(path.solver.packed().tolist(), pa.list_(pa.float64())), pa.array(solved, kind)],
                names=["dataset", "holdout", "chain", "strengths", "place", "trial", "solver", "solved"])

    state = stage(listed.select("dataset", "holdout", chain, "strengths").mapInArrow(step, state_schema))
    while True:
        is_open = F.col("place") < F.size("strengths")
        unsolved = state.where(is_open)
        if unsolved.isEmpty():
            break
        weights = unsolved.select("dataset", "chain", "holdout", F.col("trial").alias("weights"))
        sums = _added(blocks, weights, _block_derivatives, WIDTH)
        moved = unsolved.join(sums, ["dataset", "chain"]).mapInArrow(step, state_schema)
        state = stage(moved.unionByName(state.where(~is_open)))
    models = stage(state.select("dataset", "holdout", F.posexplode("solved").alias("at", "s")).select(
        "dataset", "holdout", F.concat_ws("#", "holdout", "at").alias("chain"), "s.*"))
    held = models.where(F.col("holdout") != NO_HOLDOUT).select("dataset", "chain", "holdout", F.col("coef").alias("weights"))
    answers = _added(blocks, held, _block_answers, 2)
    scored = models.join(answers, ["dataset", "chain"], "left")
    return scored.select(
        "dataset", "c", "holdout", "coef", "passes", "violation", "converged",
        *[F.coalesce(F.col("sums")[k], F.lit(0.0)).cast("long").alias(n) for k, n in enumerate(("right_rows", "held_rows"))])


def _solve(rows: DataFrame, fits: Sequence[Fit] | DataFrame, tolerance: float, max_passes: int) -> DataFrame:
    """Rows of SOLVED_SCHEMA for every requested fit that has training rows; staged.

    Raises NotConverged if a fit is not optimal.
    """
    requests = _requests(rows.sparkSession, fits)
    sizes = rows.groupBy("dataset").agg(F.count("*").alias("n"))
    large = stage(sizes.where(F.col("n") > LOCAL_ROWS).select("dataset"))
    if large.isEmpty():
        solved = _solve_small(rows, requests, tolerance, max_passes)
    else:
        small = [df.join(large, "dataset", "left_anti") for df in (rows, requests)]
        spread_out = [df.join(large, "dataset", "left_semi") for df in (rows, requests)]
        solved = _solve_small(*small, tolerance, max_passes).unionByName(
            _solve_large(*spread_out, tolerance, max_passes))
    solved = stage(solved)
    failed = solved.where(~F.col("converged")).select("dataset", "c", "holdout", "passes", "violation").head(3)
    if failed:
        raise NotConverged(f"not optimal within {max_passes} passes, for example {[tuple(r) for r in failed]}")
    return solved


def fit_l1(
    rows: DataFrame, fits: Sequence[Fit] | DataFrame, tolerance: float = 1e-6, max_passes: int = MAX_PASSES
) -> DataFrame:
    """Fit every model of ``fits`` (also a table: dataset, c, holdout) on staged :func:`training_rows`.

    ``violation`` is the remaining breach of the optimality conditions; ``tolerance`` is
    relative to the penalty ``1 / C``.  A fit that needs more than ``max_passes`` passes over
    its rows raises :class:`NotConverged`; a set without rows has no model.
    """
    return _solve(rows, fits, tolerance, max_passes).drop("converged", "right_rows", "held_rows")


def candidate_strengths(count: int = 30) -> list[float]:
    """``count`` values of C, evenly spaced on a log scale from 1e-4 to 1e4."""
    return np.logspace(-4, 4, count).tolist()


def assign_folds(
    df: DataFrame, keys: Sequence[str], n_folds: int = 5, label: str = "occupied"
) -> DataFrame:
    """Stratified folds without shuffling: consecutive blocks of each class in time order.

    Rows are numbered per class in two levels, by day and inside the day, so no task
    holds a whole series.  Needs ``day`` and ``ts``; ``df`` should be staged.
    """
    per_day = df.groupBy(*keys, "day", label).agg(
        F.count("*").alias("rows"), F.min("ts").alias("first_ts")
    )
    by_class = Window.partitionBy(*keys, label)
    whole = Window.partitionBy(*keys)
    is_first = F.min("first_ts").over(by_class) == F.min("first_ts").over(whole)
    placed = per_day.select(
        *keys,
        "day",
        label,
        F.coalesce(
            F.sum("rows").over(
                by_class.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("before"),
        F.sum("rows").over(by_class).alias("in_class"),
        F.sum("rows").over(whole).alias("in_all"),
        is_first.alias("is_first"),
    )
    in_day = Window.partitionBy(*keys, "day", label).orderBy("ts")
    number = F.col("before") + F.row_number().over(in_day) - 1
    first_size = F.when(F.col("is_first"), F.col("in_class")).otherwise(
        F.col("in_all") - F.col("in_class")
    )

    def share(total, fold: int):
        return F.ceil((total - fold) / n_folds)

    taken = F.lit(0)
    fold = F.lit(0)
    for i in range(n_folds - 1):
        own = F.when(F.col("is_first"), share(first_size, i)).otherwise(
            share(F.col("in_all"), i) - share(first_size, i)
        )
        taken = taken + own
        fold = fold + (number >= taken).cast("int")
    return df.join(placed, [*keys, "day", label]).select(*df.columns, fold.alias("fold"))


def cross_validate(
    rows: DataFrame,
    datasets: Sequence[str] | DataFrame,
    strengths: Sequence[float],
    n_folds: int = 5,
    tolerance: float = 1e-6,
    max_passes: int = MAX_PASSES,
) -> DataFrame:
    """Mean held-out accuracy of every training set and strength.

    ``datasets``: names, or a table with column ``dataset``.
    """
    names = datasets if isinstance(datasets, DataFrame) else rows.sparkSession.createDataFrame(
        [(d,) for d in datasets], "dataset STRING")
    fits = names.select("dataset").distinct().select(
        "dataset", F.explode(F.array(*[F.lit(float(c)) for c in strengths])).alias("c")
    ).select("dataset", "c", F.explode(F.array(*[F.lit(k) for k in range(n_folds)])).alias("holdout"))
    solved = _solve(rows, fits, tolerance, max_passes).where(F.col("held_rows") > 0)
    return solved.groupBy("dataset", "c").agg(
        F.avg(F.col("right_rows") / F.col("held_rows")).alias("accuracy"))


def best_strengths(scores: DataFrame) -> DataFrame:
    """Strength with the highest mean accuracy per training set; ties go to the smallest."""
    rounded = F.round("accuracy", 12)
    return scores.groupBy("dataset").agg(
        F.min_by("c", F.struct(-rounded, F.col("c"))).alias("c")
    )


def fit_l1_cv(
    rows: DataFrame,
    datasets: Sequence[str] | DataFrame,
    n_candidates: int = 30,
    n_folds: int = 5,
    tolerance: float = 1e-6,
    max_passes: int = MAX_PASSES,
) -> DataFrame:
    """Choose C by cross-validation, then fit on all rows of each training set."""
    scores = cross_validate(rows, datasets, candidate_strengths(n_candidates), n_folds, tolerance, max_passes)
    chosen = best_strengths(scores).withColumn("holdout", F.lit(NO_HOLDOUT))
    return fit_l1(rows, chosen, tolerance, max_passes)


def optimality(rows: DataFrame, models: DataFrame) -> DataFrame:
    """n_rows, n_occupied and the largest breach of the optimality conditions, relative to the
    penalty, of every model on its :func:`training_rows`; plain sums, apart from the trainer."""
    terms = [*FEATURES, "one"]
    score = sum((F.col("coef")[j] * F.col(t) for j, t in enumerate(terms)), F.lit(0.0))
    error = 1.0 / (1.0 + F.exp(-score)) - F.col("occupied")
    fitted = models.select("dataset", "c", "coef")
    sums = rows.withColumn("one", F.lit(1.0)).join(fitted, "dataset").groupBy("dataset", "c", "coef").agg(
        F.count("*").alias("n_rows"), F.sum("occupied").cast("long").alias("n_occupied"),
        F.array(*[F.sum(F.col(t) * error) for t in terms]).alias("gradient"))
    breaches = []
    for j, t in enumerate(terms):
        weight, slope, lam = F.col("coef")[j], F.col("gradient")[j], 1.0 / F.col("c")
        at_zero = F.greatest(F.abs(slope) - lam, F.lit(0.0))
        breach = F.abs(slope) if t == "one" else F.when(weight == 0, at_zero).otherwise(F.abs(slope + lam * F.signum(weight)))
        breaches.append(breach * F.col("c"))
    return sums.select("dataset", "c", "n_rows", "n_occupied", F.greatest(*breaches).alias("breach"))


def fit_mllib(rows: DataFrame, c: float = 0.1, max_iter: int = 5000, tolerance: float = 1e-12):
    """One model with Spark ML, the same objective divided by the row count."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    return LogisticRegression(
        featuresCol="features",
        labelCol="occupied",
        elasticNetParam=1.0,
        regParam=1.0 / (c * rows.count()),
        standardization=False,
        maxIter=max_iter,
        tol=tolerance,
    ).fit(assembled.select("features", "occupied"))


def coefficient_rows(models: DataFrame, cv: bool = False) -> DataFrame:
    """Long coefficient table: one row per training set and term."""
    terms = F.array(
        *[F.lit(t) for t in (*FEATURES, "Intercept", "C", "cv")]
    )
    values = F.concat("coef", F.array(F.col("c"), F.lit(1.0 if cv else 0.0)))
    return models.select(
        F.col("dataset").alias("train_home"),
        F.explode(F.arrays_zip(terms.alias("term"), values.alias("value"))).alias("t"),
    ).select("train_home", "t.term", "t.value")
