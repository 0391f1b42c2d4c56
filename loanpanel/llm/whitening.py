"""Embedding whitening by spectral divide and conquer.

The covariance of the distinct vectors is summed on Spark, centred before it is multiplied; it has as many rows as a vector has
entries, whatever the table's size, and is taken apart on the driver.  The polar factor of the covariance less a shift, found by the
QR-based dynamically weighted Halley iteration (Nakatsukasa and Higham, 2013), has the eigenvalues 1 and -1 for what lies above and
below the shift.  Half of it plus the identity projects on the upper part; an orthonormal basis of both parts splits the matrix into
two smaller ones, and so on to single components.  The components, scaled by the root of their eigenvalue, go to every task.

Cases: a vector that is NULL, empty, or holds NULL or non-finite entries is left out, as is one with an entry above 2 ** 44 / SCALE, which
has no exact sums.  Vectors of another length form a space of their own,
with its own n, components and error.  Repeated vectors count once in the fit, and all their rows are whitened; NULL and repeated ids stay.
Equal eigenvalues have some orthonormal basis of their common space.  Components without variance (eigenvalue within rounding of
zero) can't be scaled and have no rows, so fewer than two distinct vectors give none; an empty table gives none.  A deviation beyond a
long is NULL.  Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanpanel.llm.common import map_texts, written

SCALE, SHIFT = 64, 1_000_000  # a stored entry is floor(SCALE * x) + SHIFT
LARGEST = 2.0**44  # of an entry times SCALE, so that sums of a batch are exact
COMPONENTS = 16
EPS = float(np.finfo(np.float64).eps)
MAX_STEPS = 60  # of the Halley iteration; six do unless the shift is next to an eigenvalue
TRIES = 8  # shifts tried for one split


@dataclass
class Space:
    """What whitens the vectors of one length."""

    n: int
    sums: list[int]
    mean: np.ndarray  # of the entries less ``base``, which is a whole number
    base: np.ndarray
    scaled: np.ndarray  # one column per component: eigenvector over the root of its eigenvalue
    explained: np.ndarray
    error: float


def quantised(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id, x``: whole-number vectors of the rows that take part."""
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < LARGEST / scale))
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("long") + shift)
    return vectors.where(F.coalesce(fine, F.lit(False)) & (F.size("embedding") > 0)).select("vec_id", x.alias("x"))


def _per_length(column) -> dict[int, np.ndarray]:
    """The vectors of a batch as one matrix per length."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy().astype(np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    return {int(d): flat[starts[lengths == d][:, None] + np.arange(d)] for d in np.unique(lengths)}


def entry_sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """``(n, sums)`` per length, exact: one partial sum per batch and entry, added up by Spark as decimals."""
    def begin():
        def add(column):
            rows = [(d, k, len(m), total) for d, m in _per_length(column).items() for k, total in enumerate(m.sum(axis=0).tolist())]
            return list(zip(*rows)) if rows else [[]] * 4
        return lambda columns: add(*columns)

    parts = map_texts(fit.select("x"), "dim int, k int, n long, total long", begin)
    found: dict[int, tuple[int, list[int]]] = {}
    total = F.sum(F.col("total").cast("decimal(38,0)"))
    for row in parts.groupBy("dim", "k").agg(F.sum("n").alias("n"), total.alias("total")).orderBy("dim", "k").collect():
        found.setdefault(row["dim"], (row["n"], []))[1].append(int(row["total"]))
    return found


def _product_sums(rows: DataFrame, centred, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    """Sum of ``centred(x)' centred(x)`` per length; a batch gives one row of the matrix at a time, and Spark adds them up."""
    def begin():
        def multiply(column):
            out = []
            for d, m in _per_length(column).items():
                if d in sizes:
                    y = centred(d, m)
                    out += [(d, k, row) for k, row in enumerate((y.T @ y).tolist())]
            return [[r[0] for r in out], [r[1] for r in out], [r[2] for r in out]]
        return lambda columns: multiply(*columns)

    parts = map_texts(rows.select("x"), "dim int, k int, row array<double>", begin)
    cells = parts.select("dim", "k", F.posexplode("row").alias("j", "v")).groupBy("dim", "k", "j").agg(F.sum("v").alias("v"))
    out = {d: np.zeros((size, size)) for d, size in sizes.items()}
    for row in cells.collect():
        out[row["dim"]][row["k"], row["j"]] = row["v"]
    return out


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QR-based dynamically weighted Halley steps."""
    size = len(a)
    x = a / np.linalg.norm(a)  # all singular values at most 1
    # Lower bound of the least singular value, from the triangular factor and its condition in the 1-norm.
    r = np.linalg.qr(x, mode="r")
    if np.min(np.abs(np.diag(r))) > 0:
        low = max(1.0 / np.linalg.norm(np.linalg.inv(r), 2) * 0.9, EPS * EPS)
    else:
        low = EPS * EPS
    eye = np.eye(size)
    for _ in range(MAX_STEPS):
        dd = np.cbrt(4 * (1 - low * low) / low**4) if low < 1 else 0.0
        wa = np.sqrt(1 + dd) + 0.5 * np.sqrt(max(8 - 4 * dd + 8 * (2 - low * low) / (low * low * np.sqrt(1 + dd)), 0.0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack((np.sqrt(wc) * x, eye)))
        step = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:size] @ q[size:].T)
        step = (step + step.T) / 2
        low = min(low * (wa + wb * low * low) / (1 + wc * low * low), 1.0)
        moved = np.linalg.norm(step - x)
        x = step
        if moved <= (10 * EPS) ** (1 / 3) * 1e-3 and 1 - low < 10 * EPS or moved < 4 * EPS * size:
            break
    return x


def _basis(projector: np.ndarray, rank: int) -> np.ndarray:
    """An orthonormal basis whose first ``rank`` columns span the projector's range: subspace iteration from its largest columns."""
    q = np.eye(len(projector))[:, np.argsort(-np.diag(projector), kind="stable")]
    for _ in range(2):
        head, _ = np.linalg.qr(projector @ q[:, :rank])
        tail, _ = np.linalg.qr(q[:, rank:] - head @ (head.T @ q[:, rank:]))
        q = np.hstack((head, tail - head @ (head.T @ tail)))
        q, _ = np.linalg.qr(q)
    return q


def _spread(values: np.ndarray) -> list[float]:
    """Shifts to try: the middle of the diagonal first, then other places between its ends."""
    low, high = float(values.min()), float(values.max())
    return [float(np.median(values)), float(np.mean(values)), *[low + (high - low) * part for part in (0.382, 0.618, 0.17, 0.83, 0.05, 0.95)]][:TRIES]


def components(a: np.ndarray, tolerance: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    a = (a + a.T) / 2
    size = len(a)
    tolerance = max(np.linalg.norm(a) * EPS * size, 1e-300) if tolerance is None else tolerance
    away = a - np.diag(np.diag(a))
    if size == 1 or np.linalg.norm(away) <= tolerance:
        order = np.argsort(-np.diag(a), kind="stable")
        return np.diag(a)[order], np.eye(size)[:, order]
    # Bounds of the eigenvalues tell where a shift can split; the diagonal alone may be constant.
    radius = np.abs(away).sum(axis=1)
    ends = np.array([np.min(np.diag(a) - radius), np.max(np.diag(a) + radius)])
    best = None
    for shift in [*_spread(np.diag(a)), *_spread(np.concatenate((np.diag(a), ends)))]:
        projector = (polar(a - shift * np.eye(size)) + np.eye(size)) / 2
        rank = int(round(float(np.trace(projector))))
        if not 0 < rank < size:
            continue
        q = _basis(projector, rank)
        split = q.T @ a @ q
        left_over = float(np.linalg.norm(split[:rank, rank:]))
        if best is None or left_over < best[0]:
            best = (left_over, rank, q, split)
        if left_over <= 4 * tolerance:
            break
    if best is None:  # all eigenvalues are equal within rounding
        return np.sort(np.diag(a))[::-1], np.eye(size)[:, np.argsort(-np.diag(a), kind="stable")]
    _, rank, q, split = best
    high, upper = components(split[:rank, :rank], tolerance)
    low, lower = components(split[rank:, rank:], tolerance)
    values = np.concatenate((high, low))
    vectors = np.hstack((q[:, :rank] @ upper, q[:, rank:] @ lower))
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def fit_spaces(rows: DataFrame, count: int = COMPONENTS) -> dict[int, Space]:
    """Fit on the distinct vectors of ``x``; one space per length."""
    fit = written(rows.select("x").distinct(), "distinct-vectors")
    totals = entry_sums(fit)
    base = {d: np.array([s // n for s in sums], np.int64) for d, (n, sums) in totals.items()}
    mean = {d: np.array([(s - n * int(b)) / n for s, b in zip(sums, base[d])]) for d, (n, sums) in totals.items()}

    def centred(d, m):
        return (m - base[d]).astype(np.float64) - mean[d]

    products = _product_sums(fit, centred, {d: d for d in totals})
    scaled, explained = {}, {}
    for d, (n, _) in totals.items():
        covariance = products[d] / n
        values, vectors = components(covariance)
        kept = [k for k in range(min(count, d)) if values[k] > values[0] * EPS * d and values[k] > 0]
        scaled[d] = vectors[:, kept] / np.sqrt(values[kept])
        explained[d] = values[kept] / np.trace(covariance) if kept else values[:0]

    def white(d, m):
        return centred(d, m) @ scaled[d]

    after = _product_sums(fit, white, {d: scaled[d].shape[1] for d in totals if scaled[d].shape[1]})
    return {d: Space(n, sums, mean[d], base[d], scaled[d], explained[d],
                     float(np.abs(after[d] / n - np.eye(len(after[d]))).max()) if d in after else 0.0)
            for d, (n, sums) in totals.items()}


def _deviations(space: Space, m: np.ndarray) -> list[int | None]:
    """Sum of (n * x - S) ** 2 over the entries, exact; None beyond a long."""
    rest = [s - space.n * int(b) for s, b in zip(space.sums, space.base)]
    y = m - space.base
    far = space.n * int(np.abs(y).max(initial=0)) + max(map(abs, rest))
    if far * far * max(len(rest), 1) < 2**63:
        gap = space.n * y - np.array(rest, np.int64)
        return (gap * gap).sum(axis=1).tolist()
    found = [sum((space.n * v - r) ** 2 for v, r in zip(row, rest)) for row in y.tolist()]
    return [v if v < 2**63 else None for v in found]


def whiten(vectors: DataFrame, count: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row per vector and component."""
    rows = quantised(vectors, scale, shift)
    spaces = fit_spaces(rows, count)

    def begin():
        def project(ids, column):
            lengths = np.diff(column.offsets.to_numpy())
            out: list[list] = [[] for _ in range(7)]
            for d, m in _per_length(column).items():
                space, own = spaces[d], np.array(ids.to_pylist(), object)[lengths == d].tolist()
                white = ((m - space.base).astype(np.float64) - space.mean) @ space.scaled
                k = white.shape[1]
                out[0] += [v for v in own for _ in range(k)]
                out[1] += list(range(1, k + 1)) * len(m)
                out[2] += [space.n] * (k * len(m))
                out[3] += [v for v in _deviations(space, m) for _ in range(k)]
                out[4] += white.ravel().tolist()
                out[5] += space.explained.tolist() * len(m)
                out[6] += [space.error] * (k * len(m))
            return out
        return lambda columns: project(*columns)

    return map_texts(rows, "vec_id long, component int, n long, deviation long, whitened double, explained double, "
                           "identity_error double", begin)
