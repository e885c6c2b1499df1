"""Whitening of embeddings by their leading principal components, found by a block Jacobi-Davidson method.

The covariance is never formed. A product with a block of vectors is one pass over the distinct vectors: each task centres
its vectors, multiplies, and sends one number for each entry of the product, which Spark sums. The driver holds a
search space of at most ``SPACE`` vectors. Each round takes its Ritz pairs (Rayleigh-Ritz), solves the correction equation
``(I - QQ')(V - theta I)(I - QQ') t = -r`` of every pair that has not converged by a few MINRES steps, all pairs in
step so that a pass serves them all, and adds the corrections to the space. Pairs whose residual has come down to
rounding error are locked, and the rest goes on orthogonal to them. A few pairs more than asked for are corrected
too, so that close eigenvalues are not passed over.

Entries become whole numbers ``floor(256 * c)``. The distinct vectors are reduced map-side before their exchange, so that one
vector that fills a third of the table is no hot key, and are kept in packed blocks of the smallest integers that fit.
Sums are exact: whole numbers in the tasks, decimals in Spark.

Defined cases: vectors that are null, hold null or non-finite entries, or are shorter than the longest are dropped;
null ids and other kept columns pass through, whatever their names; repeated rows each get their rows; a component without variance
has null ``whitened``; with fewer dimensions than components there are as many as dimensions; a deviation that no long
can hold is null; entries beyond a long count as its ends; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import boxed, own_columns, plus, stored, unboxed

GUARDS = 4  # pairs beyond those asked for that are corrected too
SPACE = 96  # vectors of the search space before it restarts
STEPS = 3  # MINRES steps of one correction; few, as each is a pass and the space keeps what they find
ROUNDS = 200
EXACT = np.finfo(float).eps


def whole_numbers(vector: Column) -> Column:
    """``floor(256 * c)`` of every entry; null if an entry is null or not finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    return F.when(finite, F.transform(vector, lambda c: F.floor(c.cast("double") * 256) + 0))


def _matrix(batch: pa.RecordBatch, column: str = "_x") -> np.ndarray:
    lists = batch.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), -1)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block for each batch: its vectors in the smallest integers that hold them, and their exact sums."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch)
        most = max(abs(int(x.max())), abs(int(x.min())))
        kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
        sums = [str(v) for v in (x if len(x) * most < 1 << 62 else x.astype(object)).sum(axis=0)]
        columns = [pa.array([len(x)], pa.int64()), pa.array([kind]), pa.array([x.astype(kind).tobytes()], pa.binary()), pa.array([sums])]
        yield pa.RecordBatch.from_arrays(columns, names=["rows", "kind", "data", "sums"])


@dataclass
class Fit:
    """What was learned: ``components`` are columns, of falling eigenvalue."""

    n: int
    sums: list[int]
    mean: np.ndarray
    trace: float
    values: np.ndarray
    components: np.ndarray
    identity_error: float
    passes: int

    @property
    def scaled(self) -> np.ndarray:
        """Components over the roots of their eigenvalues; zero where there is no variance."""
        return self.components * np.where(self.varies, 1 / np.sqrt(np.where(self.varies, self.values, 1)), 0)

    @property
    def varies(self) -> np.ndarray:
        return self.values > len(self.mean) * EXACT * max(self.trace, 0) if len(self.values) else np.zeros(0, bool)


def _summed(blocks: DataFrame, one: Callable[[np.ndarray], np.ndarray], mean: np.ndarray) -> np.ndarray:
    """The sum of ``one`` (centred vectors -> array) over all blocks; each task adds its blocks up first."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data").to_pylist()):
                part = one(np.frombuffer(data, kind).reshape(-1, len(mean)).astype(float) - mean)
                total = part if total is None else total + part
        if total is not None:
            flat = np.ravel(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["place", "value"])

    parts = blocks.select("kind", "data").mapInArrow(added, "place bigint, value double")
    rows = parts.groupBy("place").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(rows))
    for row in rows:
        out[row.place] = row.value
    return out


def minres(b: np.ndarray, tolerance: float, steps: int) -> Generator[np.ndarray, np.ndarray, np.ndarray]:
    """Solve ``A x = b``, A symmetric, by MINRES: yields the vectors to be multiplied by A, returns x."""
    beta = np.linalg.norm(b)
    x, size = np.zeros_like(b), beta
    if beta == 0:
        return x
    v, before = b / beta, np.zeros_like(b)
    w, w_before = np.zeros_like(b), np.zeros_like(b)
    c, s, c_before, s_before = 1.0, 0.0, 1.0, 0.0
    eta, last = beta, 0.0
    for _ in range(steps):
        p = (yield v) - last * before
        alpha = v @ p
        p = p - alpha * v
        beta = np.linalg.norm(p)
        # the new column of the tridiagonal matrix under the last two rotations, then its own
        far, near = s_before * last, c_before * c * last + s * alpha
        pivot = c * alpha - c_before * s * last
        length = np.hypot(pivot, beta)
        if length == 0:
            break
        c_before, s_before, c, s = c, s, pivot / length, beta / length
        w, w_before = (v - near * w - far * w_before) / length, w
        x = x + c * eta * w
        eta, size = -s * eta, abs(s) * size
        if size <= tolerance or beta <= EXACT * size:
            break
        v, before, last = p / beta, v, beta
    return x


def _in_step(solvers: list[Generator], product: Callable[[np.ndarray], np.ndarray], project: list[Callable]) -> list[np.ndarray]:
    """Run the solvers side by side; one block product serves the step of all."""
    asked = {i: next(g, None) for i, g in enumerate(solvers)}
    solved: dict[int, np.ndarray] = {}
    while asked:
        block = product(np.column_stack(list(asked.values())))
        for i, image in zip(list(asked), block.T):
            try:
                asked[i] = solvers[i].send(project[i](image, asked[i]))
            except StopIteration as end:
                solved[i] = end.value
                del asked[i]
    return [solved[i] for i in sorted(solved)]


def _orthogonal(new: np.ndarray, to: np.ndarray) -> np.ndarray:
    """The columns of ``new`` made orthonormal to ``to`` and to each other; those that depend on them go."""
    kept = to
    for column in new.T:
        size = np.linalg.norm(column)
        if size == 0:
            continue
        column = column / size
        for _ in range(3):
            column = column - kept @ (kept.T @ column)
            size = np.linalg.norm(column)
            if size < 1e-10:
                break
            column = column / size
        else:
            kept = np.column_stack([kept, column])
    return kept[:, to.shape[1] :]


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric operator, falling, and their unit eigenvectors.

    A pair is locked when its residual is at most a few units of rounding of the largest eigenvalue, or, where rounding in the
    products does not let it come that far, when five more rounds have not lessened it.
    """
    wanted = min(wanted, size)
    locked = np.zeros((size, 0))
    space = _orthogonal(np.random.default_rng(seed).standard_normal((size, min(size, 2 * (wanted + GUARDS)))), locked)
    images = product(space)
    least: list[float] = []
    for _ in range(ROUNDS):
        values, turn = np.linalg.eigh((space.T @ images + images.T @ space) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        space, images = space @ turn, images @ turn
        residuals = images - space * values
        norms = np.linalg.norm(residuals, axis=0)
        scale = max(abs(values).max(initial=0.0), np.finfo(float).tiny)
        floor = 4 * EXACT * np.sqrt(size) * scale
        ready = 0
        while ready < min(wanted - locked.shape[1], len(values)):
            stuck = ready == 0 and len(least) > 5 and min(least[-5:]) >= 0.5 * min(least[:-5]) and norms[0] <= 1e-9 * scale
            if norms[ready] > floor and not stuck:
                break
            ready += 1
        if ready:
            locked, least = np.column_stack([locked, space[:, :ready]]), []
            space, images, values, residuals, norms = (a[..., ready:] for a in (space, images, values, residuals, norms))
            images = images - locked @ (locked.T @ images)
        if locked.shape[1] == wanted:
            break
        least.append(norms[0] if len(norms) else np.inf)
        if space.shape[1] > SPACE - 2 * (wanted + GUARDS):
            most = 2 * (wanted + GUARDS)
            space, images, values, residuals, norms = (a[..., :most] for a in (space, images, values, residuals, norms))
        solvers, projected = [], []
        for i in range(min(wanted - locked.shape[1] + GUARDS, len(values))):
            if norms[i] <= floor:
                continue
            basis = np.column_stack([locked, space[:, i]])
            off = lambda y, basis=basis: y - basis @ (basis.T @ y)
            solvers.append(minres(-off(off(residuals[:, i])), 0.01 * norms[i], STEPS))
            projected.append(lambda image, v, off=off, theta=values[i]: off(image - theta * v))
        steps = _in_step(solvers, product, projected) if solvers else []
        whole = np.column_stack([locked, space])
        more = _orthogonal(np.column_stack([*steps, np.zeros(size)]), whole)
        if not more.shape[1]:  # nothing new: go on from a direction not seen yet
            more = _orthogonal(np.random.default_rng(len(least) + seed).standard_normal((size, 1)), whole)
        if more.shape[1]:
            space, images = np.column_stack([space, more]), np.column_stack([images, product(more) if not locked.size else _less(product(more), locked)])
    else:
        raise ArithmeticError(f"only {locked.shape[1]} of {wanted} components converged")
    images = product(locked)
    values, turn = np.linalg.eigh((locked.T @ images + images.T @ locked) / 2)
    return values[::-1], (locked @ turn)[:, ::-1]


def _less(images: np.ndarray, locked: np.ndarray) -> np.ndarray:
    return images - locked @ (locked.T @ images)


def fitted(rows: DataFrame, vector: str, components: int, keep: Sequence[str] | None = None) -> tuple[Fit | None, DataFrame]:
    """What the distinct vectors teach, and the rows that remain: ``_row`` (the kept columns) and ``_x``."""
    own = own_columns(rows, keep, RESULTS)
    given = boxed(rows, own, _x=whole_numbers(F.col(f"`{vector}`"))).filter("_x is not null")
    given = stored(given, "vectors")
    size = given.agg(F.max(F.size("_x"))).first()[0] or 0
    given = given.filter(F.size("_x") == size)
    if not size:
        return None, given.filter("false")
    blocks = stored(given.select("_x").distinct().mapInArrow(_packed, "rows bigint, kind string, data binary, sums array<string>"), "blocks")
    n = blocks.agg(F.sum("rows")).first()[0]
    sums = blocks.select(F.posexplode("sums").alias("place", "sum")).groupBy("place").agg(F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"))
    exact = [int(r["sum"]) for r in sums.orderBy("place").collect()]
    mean = np.array([float(Fraction(s, n)) for s in exact])
    trace = _summed(blocks, lambda c: (c * c).sum(axis=0), mean).sum() / n
    passes = [0]

    def product(q: np.ndarray) -> np.ndarray:
        passes[0] += 1
        return _summed(blocks, lambda c: c.T @ (c @ q), mean).reshape(q.shape) / n

    values, vectors = jacobi_davidson(product, size, components)
    vectors = vectors * np.where(vectors[abs(vectors).argmax(axis=0), range(vectors.shape[1])] < 0, -1, 1)
    fit = Fit(n, exact, mean, trace, values, vectors, 0.0, passes[0])
    scaled = fit.scaled[:, fit.varies]
    k = scaled.shape[1]
    if k:
        moments = _summed(blocks, lambda c: np.vstack([(c @ scaled).T @ (c @ scaled), (c @ scaled).sum(axis=0)]), mean).reshape(k + 1, k) / n
        fit.identity_error = float(abs(moments[:k] - np.outer(moments[k], moments[k]) - np.eye(k)).max())
    return fit, given


RESULTS = ("component", "n", "deviation", "whitened", "explained", "identity_error")


def whitened(rows: DataFrame, fit: Fit | None, own: Sequence[str]) -> DataFrame:
    """For each row that ``fitted`` returns and each component: the kept columns and ``RESULTS``."""
    if fit is None:
        kept = rows.withColumns({"deviation": F.lit(0).cast("bigint"), "whitened": F.array().cast("array<double>")})
        values, trace, n, error = [], 0.0, 0, 0.0
    else:
        n, sums, mean, scaled, none = fit.n, fit.sums, fit.mean, fit.scaled, ~fit.varies
        values, trace, error = fit.values, fit.trace, fit.identity_error

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch)
                out = (x.astype(float) - mean) @ scaled
                far = n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, sums))
                small = len(mean) * far * far < 1 << 62
                off = n * (x if small else x.astype(object)) - np.array(sums, np.int64 if small else object)
                deviation = (off * off).sum(axis=1).tolist()
                deviation = pa.array([d if d < 1 << 63 else None for d in deviation], pa.int64())
                cells = pa.array(out.ravel(), mask=np.tile(none, len(x)))
                lists = pa.ListArray.from_arrays(np.arange(0, out.size + 1, out.shape[1], dtype=np.int32), cells)
                yield pa.RecordBatch.from_arrays([batch.column("_row"), deviation, lists], names=["_row", "deviation", "whitened"])

        schema = plus(rows.select("_row"), deviation="bigint", whitened="array<double>")
        kept = rows.mapInArrow(project, schema)
    shares = F.array(*[F.lit(float(v / trace) if trace > 0 else 0.0) for v in values]).cast("array<double>")
    exploded = kept.select("_row", "deviation", F.posexplode("whitened").alias("_place", "_value"))
    return unboxed(
        exploded,
        own,
        (F.col("_place") + 1).cast("int").alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        F.col("_value").alias("whitened"),
        F.get(shares, F.col("_place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
