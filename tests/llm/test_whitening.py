"""Whitening against plain numpy, and the eigenvectors against its symmetric solver."""

import math

import numpy as np
import pytest

from loanpanel.llm import queries, whitening

COLUMNS = [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
           ("explained", "double"), ("identity_error", "double")]


def matrices():
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.normal(size=(20, 20)))
    low = rng.normal(size=(8, 20))
    yield np.eye(10) * 3
    yield np.zeros((5, 5))
    yield np.ones((12, 12))
    yield np.array([[0.0, 1], [1, 0]])
    yield low.T @ low
    for values in ([5] * 10 + [1] * 10, [5] * 7 + [3] * 6 + [1] * 7, [2.0] * 19 + [-1], 10.0 ** -np.arange(20), 1 + 1e-10 * np.arange(20)):
        yield q @ np.diag(values) @ q.T
    for d in (1, 2, 3, 16, 64, 130):
        x = rng.normal(size=(500, d)) * np.linspace(1, 10, d)
        yield x.T @ x / 500


@pytest.mark.parametrize("a", list(matrices()))
def test_components(a):
    values, vectors = whitening.components(a)
    size = max(np.linalg.norm(a), 1e-300)
    assert np.all(np.diff(values) <= 0)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-14 * size
    assert np.linalg.norm(a @ vectors - vectors * values) <= 1e-14 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(a))).max() <= 1e-13


def test_polar_factor():
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.normal(size=(9, 9)))
    u = whitening.polar(q @ np.diag([9, 4, 1, 1e-3, 1e-9, -1e-6, -2, -3, -8]) @ q.T)
    assert np.abs(u - q @ np.diag([1] * 5 + [-1] * 4) @ q.T).max() < 1e-6 and np.abs(u @ u - np.eye(9)).max() < 1e-13


def brute(rows):
    """Per row: (vec_id, n, deviation), and per length the fit list, from Python integers."""
    kept = [(i, [math.floor(64 * float(np.float64(c))) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fits = {}
    for _, x in kept:
        fits.setdefault(len(x), set()).add(tuple(x))
    sums = {d: [sum(column) for column in zip(*fit)] for d, fit in fits.items()}
    return kept, fits, [(i, len(fits[len(x)]), sum((len(fits[len(x)]) * a - s) ** 2 for a, s in zip(x, sums[len(x)]))) for i, x in kept]


def odd_rows():
    rng = np.random.default_rng(7)
    rows = [(k, (rng.normal(size=24) * np.linspace(0.1, 3, 24)).astype("f4").tolist()) for k in range(120)]
    rows += [(k, rows[3][1]) for k in (3, 500, 501)] + [(None, rows[4][1])]
    rows += [(600 + k, rng.normal(size=5).astype("f4").tolist()) for k in range(30)]  # another length
    rows += [(700, [1.0, 2.0, 3.0]), (701, [1.0, 2.0, 3.0]), (702, [4.0]), (703, [5.0])]  # no variance; one component
    return rows + [(800, None), (801, []), (802, [1.0, None] * 12), (803, [float("nan")] * 24), (804, [float("inf")] + [0.0] * 23)]


@pytest.mark.parametrize("kind", ["given", "odd", "none"])
def test_query(spark, sf, tmp_path, kind):
    folder = sf
    if kind != "given":
        folder = str(tmp_path / kind)
        table = spark.createDataFrame([(*r, 1, "x") for r in odd_rows()], "vec_id long, embedding array<float>, n int, x string")
        table.limit(0 if kind == "none" else 10**6).repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    kept, fits, want = brute(rows)
    query = queries.corpus_queries()["op11_whitening"](spark, folder)
    assert query.dtypes == COLUMNS
    got = query.collect()
    shown = {d: min(16, d if len(fit) > 1 else 0) for d, fit in fits.items()}
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted([(r.vec_id, r.n, r.deviation) for r in got if r.component == 1], key=key) == sorted(
        [w for w, (_, x) in zip(want, kept) if shown[len(x)]], key=key)
    assert len(got) == sum(shown[len(x)] for _, x in kept)
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    for d, fit in fits.items():
        if not shown[d]:
            continue
        z = np.array(sorted(fit)) - 1_000_000.0
        z -= z.mean(axis=0)
        values, vectors = np.linalg.eigh(z.T @ z / len(z))
        values, vectors = values[::-1], vectors[:, ::-1]
        for i, x in kept:
            if len(x) == d and i is not None:
                found = by_id[i]
                y = (np.array(x) - 1_000_000.0 - (np.array(sorted(fit)) - 1_000_000.0).mean(axis=0)) @ vectors
                for k in range(shown[d]):
                    assert abs(abs(found[k + 1].whitened) - abs(y[k] / math.sqrt(values[k]))) < 1e-6
                    assert abs(found[k + 1].explained / (values[k] / values.sum()) - 1) < 1e-9
                    assert found[k + 1].identity_error < 1e-9
        # the same sign for all rows: whitened entries of the fit list have the identity as covariance
        ids = {tuple(x): i for i, x in kept if len(x) == d and i is not None}
        w = np.array([[by_id[i][k + 1].whitened for k in range(shown[d])] for i in ids.values()])
        if len(w) == len(fit):
            assert np.abs(w.T @ w / len(w) - np.eye(shown[d])).max() < 1e-9


def test_deviations_beyond_a_double_and_a_long():
    space = whitening.Space(10**6, [10**6 * 5 + 3, 7], np.zeros(2), np.array([5, 0]), np.zeros((2, 0)), np.zeros(0), 0.0)
    m = np.array([[5 + 1000, 1], [5 + 3000, 0], [5 + 4_000_000, 2]])
    want = [(10**6 * a - 10**6 * 5 - 3) ** 2 + (10**6 * b - 7) ** 2 for a, b in m.tolist()]
    assert whitening._deviations(space, m) == [v if v < 2**63 else None for v in want] and want[-1] >= 2**63 > want[1] > 2**53
