"""Linear SVM by a quasi-Newton search whose vectors never leave the executors.

The model of Spark ML's ``LinearSVC`` without intercept and standardisation: hinge loss, L2 penalty,
terms divided by their standard deviation while searching, OWL-QN of ``MEMORY`` steps from zero with the
line search and stop rules of ``LinearSVC``. That one sends a gradient of all terms to the driver in
every evaluation; here weights, gradient and the search's history stay with the blocks of terms.

The next direction is a sum of history vectors and gradient, so the driver needs only their inner
products (at most 21 x 21 numbers a task) and sends back one factor a vector. An evaluation adds up
the margins by one shuffle and gives the driver one bit a row (has it a loss?) and the loss; an
accepted point is then made from the bits, one job without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators.svm import DOCS_PER_PARTITION, SLICE_ENTRIES, TASK_ENTRIES, term_blocks
from revlens.session import _delete, drop_table, ensure_checkpoint_dir, reopen

TOLERANCE = 1e-6
#: Steps and gradient changes that the search remembers.
MEMORY = 10
# Line search: sufficient decrease, curvature, growth of a step, most changes of a step, its limits.
ARMIJO, WOLFE, GROW, MAX_CHANGES, MIN_STEP, MAX_STEP = 1e-4, 0.9, 2.1, 20, 1e-10, 1e10
VALUES_KEPT = 20
#: Accepted points after which the search's vectors are checkpointed, which cuts their lineage.
CHECKPOINT_EVERY = 10


class SearchFailed(Exception):
    """No step of the direction helps, or the history gives no direction."""


def _scaled(n_rows: int):
    """Block rows to one list a task: (begins, terms, docs, signed values over deviation, 1 / deviation)."""
    def run(rows: Iterator) -> Iterator[list]:
        blocks = []
        for row in rows:
            begins, terms, docs, values = (np.frombuffer(c, t) for c, t in zip(row[1:], ("<i8", "<i4", "<i4", "<f8")))
            sizes, x = np.diff(np.append(begins, len(docs))), np.abs(values)
            mean = np.add.reduceat(x, begins) / n_rows
            squares = np.add.reduceat((x - np.repeat(mean, sizes)) ** 2, begins) + (n_rows - sizes) * mean ** 2
            same = (sizes == n_rows) & (np.maximum.reduceat(x, begins) == np.minimum.reduceat(x, begins))
            deviation = np.where(same, 0.0, np.sqrt(squares / max(n_rows - 1, 1))) * (n_rows > 1)
            scale = np.divide(1.0, deviation, out=np.zeros(len(begins)), where=deviation > 0)
            blocks.append((begins, terms, docs, values * np.repeat(scale, sizes), scale))
        yield blocks

    return run


def _start(n_rows: int):
    """Blocks to their vectors at zero, where every row has a loss: (weights, gradient, steps, changes)."""
    def run(tasks: Iterator[list]) -> Iterator[tuple]:
        for blocks in tasks:
            vectors, products = [], np.zeros((1, 1))
            for begins, _, _, values, _ in blocks:
                g, none = -np.add.reduceat(values, begins) / n_rows, np.zeros((0, len(begins)))
                products += g @ g
                vectors.append((np.zeros(len(begins)), g, none, none))
            yield vectors, 0.0, products

    return run


def _moved(plan: tuple, vectors: tuple) -> tuple[np.ndarray, np.ndarray]:
    """A block's direction and its weights after the step: a term keeps its sign or becomes zero."""
    of_steps, of_changes, of_gradient, length = plan
    w, g, steps, changes = vectors
    d = of_gradient * g + of_steps @ steps[:len(of_steps)] + of_changes @ changes[:len(of_changes)]
    d = np.where(d * g < 0, d, 0.0)
    new = w + length * d
    return d, np.where(np.sign(new) == np.where(w != 0, np.sign(w), np.sign(-g)), new, 0.0)


def _shares(plan, begins_of: np.ndarray):
    """Blocks and vectors to (group, (task, share)): a task's share of the groups' margins, times the
    signs; in group -1 its share of the penalty and of the slope at the step's begin."""
    def run(task: int, pairs: Iterator[tuple]) -> Iterator[tuple]:
        for blocks, (vectors, _, _) in pairs:
            total, sums = np.zeros(int(begins_of[-1])), np.zeros(2)
            for (begins, _, docs, values, scale), own in zip(blocks, vectors):
                d, w = _moved(plan.value, own)
                sums += (w * scale) @ (w * scale), own[1] @ d
                total += np.bincount(docs, values * np.repeat(w, np.diff(np.append(begins, len(docs)))), minlength=len(total))
            yield -1, (task, sums)
            for group, share in enumerate(np.split(total, begins_of[1:-1])):
                yield group, (task, share)

    return run


def _losses(group: tuple) -> tuple:
    """All tasks' shares of a group to its loss and one bit a row."""
    number, shares = group
    # sums do not depend on the order in which tasks end
    total = np.sum([share for _, share in sorted(shares, key=lambda s: s[0])], axis=0)
    if number < 0:
        return number, total.tolist(), b""
    loss = 1.0 - total
    return number, float(loss[loss > 0].sum()), np.packbits(loss > 0).tobytes()


def _advance(plan, bits, begins_of: np.ndarray, n_rows: int, reg_param: float):
    """Blocks and vectors to the vectors after the step, its slope there and their inner products."""
    def run(pairs: Iterator[tuple]) -> Iterator[tuple]:
        active = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=int(n))
                                 for b, n in zip(bits.value, np.diff(begins_of))]).astype(float)
        kept = len(plan.value[0])
        for blocks, (vectors, _, _) in pairs:
            after, slope, products = [], 0.0, 0.0
            for (begins, _, docs, values, scale), own in zip(blocks, vectors):
                d, w = _moved(plan.value, own)
                g = reg_param * w * scale ** 2 - np.add.reduceat(values * active[docs], begins) / n_rows
                steps = np.vstack([w - own[0], own[2][:kept]])[:MEMORY]
                changes = np.vstack([g - own[1], own[3][:kept]])[:MEMORY]
                all_of_them = np.vstack([steps, changes, g])
                slope += float(g @ d)
                products = products + all_of_them @ all_of_them.T
                after.append((w, g, steps, changes))
            yield after, slope, products

    return run


def _factors(products: np.ndarray, kept: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The quasi-Newton direction as factors of steps, changes and gradient (two-loop recursion)."""
    held = len(products) // 2
    direction = np.zeros(len(products))
    direction[-1] = 1.0
    first = np.zeros(kept)
    with np.errstate(all="ignore"):
        diagonal = 1.0
        if kept:
            if not products[0, held] >= 0:
                raise SearchFailed
            diagonal = products[0, held] / products[held, held]
        for i in range(kept):
            first[i] = products[i] @ direction / products[i, held + i]
            if np.isnan(first[i]):
                raise SearchFailed
            direction[held + i] -= first[i]
        direction *= diagonal
        for i in reversed(range(kept)):
            direction[i] += first[i] - products[held + i] @ direction / products[i, held + i]
    return -direction[:kept], -direction[held:held + kept], -float(direction[-1])


class _Search:
    """The search's vectors on the executors and what the driver knows of them."""

    def __init__(self, session: SparkSession, blocks: RDD, begins_of: np.ndarray, n_rows: int, reg_param: float):
        self.session, self.sc, self.blocks, self.begins_of = session, session.sparkContext, blocks, begins_of
        self.n_rows, self.reg_param = n_rows, reg_param
        self.groups = min(self.sc.defaultParallelism, len(begins_of))
        self.kept, self.value, self.points = 0, 1.0, 0
        # a lost vector is made again from the plans and bits since the last checkpoint, whose own it still names
        self.shared, self.shared_before, self.files = [], [], []
        self.vectors = blocks.mapPartitions(_start(n_rows)).persist(StorageLevel.MEMORY_AND_DISK)
        _, self.products = self._sums(self.vectors)

    @staticmethod
    def _sums(vectors: RDD) -> tuple[float, np.ndarray]:
        told = [t for t in vectors.map(lambda v: v[1:]).collect() if np.ndim(t[1])]  # not of tasks without blocks
        return sum(s for s, _ in told), np.sum([p for _, p in told], axis=0)

    def norm(self) -> float:
        return math.sqrt(self.products[-1, -1])

    def evaluate(self, factors: tuple, length: float) -> tuple:
        """(loss with penalty, slope at the step's begin, the shared plan, bits) of a step of this length."""
        plan = self.sc.broadcast((*factors, length))
        self.shared.append(plan)
        told = (self.blocks.zip(self.vectors).mapPartitionsWithIndex(_shares(plan, self.begins_of))
                .groupByKey(self.groups).map(_losses).collect())
        told = sorted(told)
        penalty, slope = told[0][1]
        # rows without any term have a loss of 1
        loss = sum(t[1] for t in told[1:]) + self.n_rows - int(self.begins_of[-1])
        return loss / self.n_rows + 0.5 * self.reg_param * penalty, slope, plan, [t[2] for t in told[1:]]

    def advance(self, plan, bits: list[bytes]) -> tuple[RDD, float, np.ndarray]:
        bits = self.sc.broadcast(bits)
        self.shared.append(bits)
        vectors = (self.blocks.zip(self.vectors)
                   .mapPartitions(_advance(plan, bits, self.begins_of, self.n_rows, self.reg_param))
                   .persist(StorageLevel.MEMORY_AND_DISK))
        if (self.points + 1) % CHECKPOINT_EVERY == 0:
            vectors.checkpoint()
        return vectors, *self._sums(vectors)

    def step(self, first: bool) -> None:
        """Search along the next direction and go there."""
        factors = _factors(self.products, self.kept)
        length, shrink = (0.5 / self.norm(), 0.1) if first else (1.0, 0.5)
        # as in LinearSVC, a search takes the value at its begin for that of its first step: a falling
        # direction shrinks that step unseen
        value, at, found = self.value, None, self.evaluate(factors, length * shrink)
        slope, ahead = found[1], found
        for changes in range(MAX_CHANGES + 1):
            if value > self.value + length * slope * ARMIJO:
                change = shrink
            else:
                at = at or self.evaluate(factors, length)
                vectors, end, products = self.advance(*at[2:])
                if end < WOLFE * slope:
                    change = GROW
                elif end > -WOLFE * slope:
                    change = shrink
                else:
                    self._take(vectors, products, at[0])
                    return
                self._forget(vectors)
            length *= change
            if changes == MAX_CHANGES or not MIN_STEP <= length <= MAX_STEP:
                break
            at = ahead if ahead and change == shrink else self.evaluate(factors, length)
            value, ahead = at[0], None
        raise SearchFailed

    def _take(self, vectors: RDD, products: np.ndarray, value: float) -> None:
        self.vectors.unpersist()
        self.vectors, self.products, self.value = vectors, products, value
        self.kept, self.points = min(self.kept + 1, MEMORY), self.points + 1
        if vectors.isCheckpointed():
            self._drop(self.shared_before)
            self.shared, self.shared_before, self.files = [], self.shared, [vectors.getCheckpointFile()]

    def _forget(self, vectors: RDD) -> None:
        vectors.unpersist()
        if vectors.isCheckpointed():
            self.files.append(vectors.getCheckpointFile())

    def _drop(self, shared: list) -> None:
        for value in shared:
            value.destroy()
        for path in self.files:
            _delete(self.session, path)

    def close(self) -> None:
        self.vectors.unpersist()
        self.blocks.unpersist()
        self._drop(self.shared_before + self.shared)


def svc_fit(src: DataFrame, n_terms: int, n_rows: int, iterations: int, reg_param: float,
            tolerance: float = TOLERANCE) -> np.ndarray:
    """The weights of all terms from written rows ``(key, term, x, ys)``, x at least 0 and ys -1 or 1;
    ``n_rows`` also counts rows without terms."""
    weights = np.zeros(n_terms)
    ensure_checkpoint_dir(src.sparkSession)
    loop = src.sparkSession.newSession()
    loop.conf.set("spark.sql.adaptive.enabled", "false")
    parts = max(1, math.ceil(n_rows / DOCS_PER_PARTITION))
    loop.conf.set("spark.sql.shuffle.partitions", str(parts))
    written, begins_of, entries = term_blocks(reopen(src, loop), loop, "key", parts)
    if written is None:
        return weights
    tasks = max(1, min(loop.sparkContext.defaultParallelism, math.ceil(entries / TASK_ENTRIES)),
                math.ceil(entries / SLICE_ENTRIES))
    # cached for the search; a lost block is read again from the written blocks
    blocks = (written.repartitionById(tasks, F.col("slice") % tasks).rdd.mapPartitions(_scaled(n_rows))
              .persist(StorageLevel.MEMORY_AND_DISK))
    search = _Search(loop, blocks, begins_of, n_rows, reg_param)
    values, first_value, failed = [math.inf], search.value, False
    while search.points < iterations and search.norm() > max(tolerance * search.value, 1e-8):
        if len(values) > 1 and abs(search.value - max(values)) <= tolerance * first_value:
            break
        try:
            search.step(search.points == 0)
        except SearchFailed:
            if failed:
                break
            failed, search.kept = True, 0  # once more, along the gradient
        else:
            failed, values = False, [*values, search.value][-VALUES_KEPT:]
    told = blocks.zip(search.vectors).flatMap(
        lambda pair: [(b[1], v[0] * b[4]) for b, v in zip(pair[0], pair[1][0])]).collect()
    for terms, w in told:
        weights[terms] = w
    search.close()
    drop_table(written)
    return weights
