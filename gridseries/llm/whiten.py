"""Whitening of embeddings by singular values of the centred rows.

1. Rows become whole numbers (``floor(STEP * entry) + SHIFT``), each distinct vector once: the fit list. Sums are exact.
2. Blockwise QR: a task centres its rows exactly (``(n * x - S) / n``) and keeps only the triangle R of their QR factorisation;
   triangles of neighbouring tasks are stacked and factored again, in a tree, until one is left.
3. That one (dimension x dimension, on the driver) is made bidiagonal by Householder reflections from both sides. dqds finds
   its singular values to high relative accuracy; a twisted factorisation of each shifted tridiagonal gives its vector, and
   vectors of close values are made orthogonal by inverse iteration. The covariance itself is never formed.
4. Rows are projected on the directions and divided by the standard deviations. The whitened fit list's covariance, merged
   from the moments of tasks, tells how far from the identity it is.

Null vectors, vectors with null or non-finite entries and vectors whose numbers double precision can't hold (beyond 2^53)
are dropped. So are empty vectors and vectors of another length than the most frequent one (of equally frequent ones the
longer): they are no points of the space. Null ids and repeated rows are rows like others, a vector counts once in the fit.
Directions without variance (as of constant entries, or of fewer vectors than dimensions) have the whitened value null.
An empty table gives an empty result. Columns of the input are left out but for the id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from gridseries.llm.scratch import stored

STEP = 64
SHIFT = 1_000_000
EXACT = 2.0**53
FAN_IN = 32
BLOCK_ROWS = 4096
CLOSE = 1e-3
EPS = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Whitening:
    """A fit: exact count and sums, directions as columns by falling variance, their variances, and the total variance."""

    count: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    total: float


# The bidiagonal problem, on the driver: its size is the dimension


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and V of a bidiagonal B with ``r = U B V'``, by Householder reflections."""
    a, n = r.astype(float).copy(), r.shape[1]
    v = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        """A unit vector h for which x - 2 h (h . x) is a multiple of the first axis."""
        scale = np.abs(x).max()
        if scale == 0 or len(x) == 1:
            return None
        h = x / scale
        h[0] += math.copysign(float(np.linalg.norm(h)), h[0])
        return h / np.linalg.norm(h)

    for k in range(n):
        h = reflector(a[k:, k])
        if h is not None:
            a[k:, k:] -= 2 * np.outer(h, h @ a[k:, k:])
        if k < n - 2:
            h = reflector(a[k, k + 1:])
            if h is not None:
                a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ h, h)
                v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ h, h)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential qd step with a shift; None if the shift is above the least value."""
    d, out_q, out_e = q[0] - shift, [], []
    for k in range(len(q) - 1):
        if d < 0:
            return None
        top = d + e[k]
        out_q.append(top)
        ratio = q[k + 1] / top if top > 0 else 0.0
        out_e.append(e[k] * ratio)
        d = d * ratio - shift
    return (out_q + [d], out_e) if d >= 0 else None


def _least_bound(q: list[float], e: list[float]) -> float:
    """A number below the least value, by Gershgorin's discs of the tridiagonal, from its last few rows up."""
    bound = math.inf
    for k in range(len(q)):
        side = (math.sqrt(q[k] * e[k]) if k < len(e) else 0) + (math.sqrt(q[k - 1] * e[k - 1]) if k else 0)
        bound = min(bound, q[k] + (e[k - 1] if k else 0) - side)
    return max(bound, 0.0)


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix, falling, each to high relative accuracy."""
    found: list[float] = []
    work = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    while work:
        q, e, base = work.pop()
        while q:
            n = len(q)
            if n == 1:
                found.append(q[0] + base)
                break
            split = next((k for k in range(n - 2, -1, -1) if e[k] <= EPS**2 * (q[k] + base) or e[k] == 0.0), None)
            if split is not None:
                work.append((q[split + 1:], e[split + 1:], base))
                q, e = q[: split + 1], e[:split]
                continue
            # The last q is close to the least value once its e is small; a step below zero is taken back.
            shift = max(_least_bound(q, e), q[-1] * (1 - math.sqrt(e[-1] / (q[-1] + e[-1]))) if q[-1] > 0 else 0.0)
            step = None
            for _ in range(4):
                step = _dqds_step(q, e, shift)
                if step or shift == 0:
                    break
                shift /= 8
            if step is None:
                shift, step = 0.0, _dqds_step(q, e, 0.0)
            q, e = step
            base += shift
    return np.array(sorted(found, reverse=True))


def _twisted(q: np.ndarray, e: np.ndarray, value: float) -> np.ndarray:
    """A unit vector z with (B'B - value) z near zero, B'B = L D L' from the qd array, by the twist of least pivot."""
    n = len(q)
    tiny = float(np.finfo(float).tiny)
    low = np.zeros(max(n - 1, 0))  # L of B'B: row k + 1 holds sqrt(e_k / q_k)
    low[:] = np.sqrt(e / np.maximum(q[:-1], tiny)) if n > 1 else 0
    s, plus_l, sums = -value, np.zeros(max(n - 1, 0)), np.zeros(n)
    for k in range(n - 1):  # stationary: L+ D+ L+' from the top
        sums[k] = s
        d = s + q[k]
        d = d if abs(d) > tiny else -EPS * max(q[k], tiny)
        plus_l[k] = q[k] * low[k] / d
        s = plus_l[k] * low[k] * s - value
    sums[n - 1] = s
    p, minus_u, sums_up = q[n - 1] - value, np.zeros(max(n - 1, 0)), np.zeros(n)
    sums_up[n - 1] = p
    for k in range(n - 2, -1, -1):  # progressive: U- D- U-' from the bottom
        d = q[k] * low[k] ** 2 + p
        d = d if abs(d) > tiny else -EPS * max(q[k], tiny)
        ratio = q[k] / d
        minus_u[k] = low[k] * ratio
        p = p * ratio - value
        sums_up[k] = p
    r = int(np.argmin(np.abs(sums + sums_up + value)))
    z = np.zeros(n)
    z[r] = 1.0
    for k in range(r - 1, -1, -1):
        z[k] = -plus_l[k] * z[k + 1]
    for k in range(r, n - 1):
        z[k + 1] = -minus_u[k] * z[k]
    return z / np.linalg.norm(z)


def _block_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Vectors of one block without zeros above the diagonal, as columns in the order of its values."""
    q, e, out = diagonal**2, above**2, []
    middle = diagonal**2 + np.concatenate(([0.0], e))
    side = diagonal[:-1] * above
    full = np.diag(middle) + np.diag(side, 1) + np.diag(side, -1)
    rng = np.random.default_rng(len(q))
    for i, value in enumerate(values):
        # The qd array forgets signs; they come back along the chain of products.
        z = _twisted(q, e, value)
        z = z * np.cumprod(np.concatenate(([1.0], np.where(side < 0, -1.0, 1.0))))
        near = [j for j in range(i) if abs(values[j] - value) <= CLOSE * max(values[j], EPS * values[0])]
        if near:
            z = _inverse_iteration(full, value, values[0], z, np.stack([out[j] for j in near], axis=1), rng)
        out.append(z)
    found = np.stack(out, axis=1)
    return found @ (1.5 * np.eye(len(q)) - 0.5 * found.T @ found)  # one step towards exactly orthogonal ones


def _inverse_iteration(full: np.ndarray, value: float, largest: float, z: np.ndarray, others: np.ndarray,
                       rng: np.random.Generator) -> np.ndarray:
    """A vector of ``value`` orthogonal to those of close values, from a start that may be one of them."""
    shifted = full - (value + 4 * EPS * largest) * np.eye(len(z))

    def apart(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - others @ (others.T @ x)
        return x

    z = apart(z)
    for _ in range(4):
        while np.linalg.norm(z) < 1e-3:
            z = apart(rng.standard_normal(len(z)) / math.sqrt(len(z)))
        z = np.linalg.solve(shifted, z / np.linalg.norm(z))
        z = apart(z / np.linalg.norm(z))
    return z / np.linalg.norm(z)


def singular_directions(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a matrix, falling, and its right singular vectors as columns."""
    diagonal, above, v = bidiagonal(r)
    n, scale = len(diagonal), float(np.abs(r).max()) if r.size else 0.0
    if scale == 0:
        return np.zeros(n), np.eye(n)
    largest = float(max(np.abs(diagonal).max(), np.abs(above).max() if n > 1 else 0.0))
    # Zeros above the diagonal part the problem; a zero on it ends its block with a value of zero.
    floor = EPS * largest
    above = np.where(np.abs(above) <= floor * EPS, 0.0, above)
    diagonal = np.where(np.abs(diagonal) <= floor * n, floor * EPS, diagonal)
    values, vectors, first = [], [], 0
    for k in range(n):
        if k == n - 1 or above[k] == 0:
            some = dqds(diagonal[first: k + 1], above[first:k])
            part = np.zeros((n, len(some)))
            part[first: k + 1] = _block_vectors(diagonal[first: k + 1], above[first:k], some)
            values.append(some)
            vectors.append(part)
            first = k + 1
    values, z = np.concatenate(values), np.concatenate(vectors, axis=1)
    order = np.argsort(-values, kind="stable")
    return values[order], v @ z[:, order]


# The points


def points(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """The usable rows with their whole numbers as ``x``; other columns travel in ``row``."""
    kept = [F.col(f"`{c}`") for c in embeddings.columns if c != vector]
    entry = F.col(f"`{vector}`").cast("array<double>")
    rows = embeddings.select(F.struct(*kept).alias("row") if kept else F.struct(F.lit(1).alias("one")).alias("row"),
                             entry.alias("entries"))
    room = F.lit((EXACT - SHIFT) / STEP)
    usable = rows.filter((F.size("entries") > 0) & F.forall(
        "entries", lambda c: F.coalesce((c < room) & (c > -room), F.lit(False))))  # a NaN is larger than all
    best = usable.groupBy(F.size("entries").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return usable.filter(F.size("entries") == (best["size"] if best else 0)).select("row", F.transform(
        "entries", lambda c: F.floor(c * STEP) + F.lit(SHIFT)).cast("array<bigint>").alias("x"))


def fit_list(found: DataFrame) -> DataFrame:
    return stored(found.select("x").distinct())


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


# Sums over tasks


def _per_task(rows: DataFrame, state: Callable[[Iterator[np.ndarray]], np.ndarray | None]) -> DataFrame:
    """(seq, state): what each task with rows makes of its blocks of ``x``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (_matrix(batch.column(0).slice(at, BLOCK_ROWS)) for batch in batches
                  for at in range(0, len(batch), BLOCK_ROWS))
        found = state(blocks)
        if found is not None:
            yield pa.RecordBatch.from_arrays([
                pa.array([TaskContext.get().partitionId()], pa.int64()),
                pa.array([found.ravel().tolist()], pa.list_(pa.float64()))], ["seq", "state"])

    return rows.select("x").mapInArrow(run, "seq long, state array<double>")


def _merged(parts: DataFrame, merge: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """The states of all tasks as one, ``FAN_IN`` neighbours at a time."""
    def some(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        state = merge([np.array(s) for s in rows.sort_values("seq")["state"]])
        return pd.DataFrame({"seq": [int(key[0])], "state": [state.ravel().tolist()]})

    parts = stored(parts)
    while parts.count() > 1:
        parts = stored(parts.withColumn("group", F.floor(F.col("seq") / FAN_IN).cast("long")).groupBy("group").applyInPandas(
            some, "seq long, state array<double>"))
    last = parts.first()
    return np.array(last["state"]) if last else None


def _exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """The number of points and their sum in each dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, high, low = 0, 0, 0
        for batch in batches:
            x = _matrix(batch.column(0))
            count, high, low = count + len(x), high + (x >> 26).sum(axis=0), low + (x & (2**26 - 1)).sum(axis=0)
        if count:
            size = len(high)
            yield pa.RecordBatch.from_arrays([
                pa.array(range(size), pa.int32()), pa.array([count] * size, pa.int64()), pa.array(high, pa.int64()),
                pa.array(low, pa.int64())], ["at", "count", "high", "low"])

    sums = rows.select("x").mapInArrow(run, "at int, count long, high long, low long").groupBy("at").agg(
        F.sum("count").alias("count"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
        F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).orderBy("at").collect()  # a row per dimension
    return (int(sums[0]["count"]) if sums else 0), [(int(r["high"]) << 26) + int(r["low"]) for r in sums]


def _deviations(x: np.ndarray, count: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, exact: 64-bit integers where they hold it, else Python's."""
    largest = max(int(np.abs(x).max(initial=0)) * count, max(map(abs, sums)))
    if largest < 2**62:
        return count * x - np.array(sums, np.int64)
    return count * x.astype(object) - np.array(sums, object)


def _triangle(a: np.ndarray) -> np.ndarray:
    """R of a QR factorisation, filled up with zero rows to a square."""
    r = np.linalg.qr(a, mode="r")
    return np.vstack([r, np.zeros((a.shape[1] - len(r), a.shape[1]))]) if len(r) < a.shape[1] else r


def fit(rows: DataFrame) -> Whitening | None:
    """The whitening of a fit list; None if it is empty."""
    count, sums = _exact_sums(rows)
    if not count:
        return None
    size = len(sums)

    def reduce(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
        r = None
        for x in blocks:
            centred = _deviations(x, count, sums).astype(float) / count
            r = _triangle(centred if r is None else np.vstack([r, centred]))
        return r

    def stack(states: list[np.ndarray]) -> np.ndarray:
        return _triangle(np.vstack([s.reshape(size, size) for s in states]))

    r = _merged(_per_task(rows, reduce), stack).reshape(size, size)
    squares, directions = singular_directions(r)
    squares = np.where(squares > (size * EPS) ** 2 * squares[0], squares, 0.0)
    directions = directions * np.where(directions[np.abs(directions).argmax(axis=0), np.arange(size)] < 0, -1.0, 1.0)
    return Whitening(count, sums, directions, squares / count, float(squares.sum()) / count)


def _projection(model: Whitening, components: int) -> np.ndarray:
    """Directions over standard deviations; NaN where there is no variance."""
    variances = model.variances[:components]
    return model.directions[:, :components] / np.sqrt(np.where(variances > 0, variances, np.nan))


def identity_error(rows: DataFrame, model: Whitening, components: int = 16) -> float | None:
    """The largest absolute entry of the whitened fit list's covariance minus the identity, over directions with variance."""
    onto = _projection(model, int((model.variances[:components] > 0).sum()))
    count, sums, k = model.count, model.sums, onto.shape[1]
    if not k:
        return None

    def moments(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
        states = []
        for x in blocks:
            white = (_deviations(x, count, sums).astype(float) / count) @ onto
            mean = white.mean(axis=0)
            states = [join([*states, np.concatenate(([len(x)], mean, ((white - mean).T @ (white - mean)).ravel()))])]
        return states[0] if states else None

    def join(states: list[np.ndarray]) -> np.ndarray:
        """Counts, means and centred products of parts as those of the whole."""
        n = sum(s[0] for s in states)
        mean = sum(s[0] * s[1: k + 1] for s in states) / n
        products = sum(s[k + 1:].reshape(k, k) + s[0] * np.outer(s[1: k + 1] - mean, s[1: k + 1] - mean) for s in states)
        return np.concatenate(([n], mean, products.ravel()))

    found = _merged(_per_task(rows, moments), join)
    return float(np.abs(found[k + 1:].reshape(k, k) / found[0] - np.eye(k)).max())


def whitened(found: DataFrame, model: Whitening, components: int = 16) -> DataFrame:
    """Points with ``deviation`` (null beyond a long) and the array ``whitened``, null where there is no variance."""
    onto, count, sums = _projection(model, components), model.count, model.sums
    schema = StructType([found.schema["row"], *StructType.fromDDL("deviation long, whitened array<double>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            away = _deviations(_matrix(batch.column(1)), count, sums)
            small = away.dtype != object and float((away.astype(float) ** 2).sum(axis=1).max()) < 2.0**62
            squared = (away if small else away.astype(object)) ** 2
            exact = [s if s < 2**63 else None for s in squared.sum(axis=1).tolist()]
            white = (away.astype(float) / count) @ onto
            flat = pa.array(white.ravel(), mask=np.isnan(white.ravel()))
            ends = pa.array(np.arange(0, white.size + 1, white.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(exact, pa.int64()), pa.ListArray.from_arrays(ends, flat)], schema.names)

    return found.select("row", "x").mapInArrow(run, schema)


def whiten(embeddings: DataFrame, components: int = 16, identity: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row per usable row and component: the id, component, n, deviation, whitened, explained and identity_error."""
    kind = embeddings.schema[identity].dataType
    found = points(embeddings.select(identity, vector), vector)
    rows = fit_list(found)
    model = fit(rows)
    shape = StructType([StructField(identity, kind), *StructType.fromDDL(
        "component int, n long, deviation long, whitened double, explained double, identity_error double").fields])
    if model is None:
        return embeddings.sparkSession.createDataFrame([], shape)
    error, total = identity_error(rows, model, components), model.total
    shares = F.array(*[F.lit(float(v / total) if total else None).cast("double") for v in model.variances[:components]])
    return whitened(found, model, components).select(
        F.col("row")[identity].alias(identity), "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        identity, (F.col("at") + 1).alias("component"), F.lit(model.count).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
