"""Operators on embeddings against brute force, and their edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlemill.llm import hard_negatives as hard
from candlemill.llm import hnsw, whitening
from candlemill.llm.vectors import binary, matrices, packed, unpacked

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, dims string, score string"
NAN, INF = float("nan"), float("inf")


def vectors(seed, count, dims=12, spread=True):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((count, dims))
    return x * np.linspace(3, 0.5, dims) if spread else x / np.linalg.norm(x, axis=1)[:, None]


def frame(spark, rows, parts=3):
    """Rows ``(vec_id, embedding, label)`` beside columns whose names the operators use themselves."""
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], label, "a", "b", "c") for i, v, label in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def unusable():
    """Rows that take no part in any of the three."""
    return [(9001, None, 1), (9002, [None] * 12, 1), (9003, [NAN] + [1.0] * 11, 1), (9004, [INF] + [1.0] * 11, 1), (9005, [], 1)]


# --- whitening ---------------------------------------------------------------


def whitened_by_hand(x, fit, count=16):
    n, mean = len(fit), fit.mean(axis=0)
    values, turn = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    values, turn = values[::-1][:count], turn[:, ::-1][:, :count]
    kept = values > 1e-9 * values[0]
    return ((x - mean) @ turn / np.sqrt(np.where(kept, values, 1)))[:, kept], values[kept] / np.trace(np.cov(fit.T, bias=True))


@pytest.mark.parametrize("dims, count, fan_in", [(12, 400, 128), (50, 600, 2)])
def test_whitening_equals_dense_eigenvectors(spark, dims, count, fan_in):
    x = vectors(dims, count, dims)
    rows = [(i, v, 0) for i, v in enumerate(x)]
    # A common vector counts once in the fit, and each of its rows is returned.
    rows += [(5000 + i, x[0], 0) for i in range(900)]
    odd = [(9001, [None] * dims, 1), (9002, None, 1), (9003, [NAN] * dims, 1), (9004, [1.0] * (dims - 1), 1), (9005, [1e30] * dims, 1)]
    got = whitening.whitened(frame(spark, rows + odd, 7), fan_in=fan_in).toPandas()
    assert got.columns.tolist() == [c.split()[0] for c in whitening.OUTPUT.split(", ")]
    whole = np.floor(64 * np.array([v for _, v, _ in rows]))
    fit = np.unique(whole, axis=0)
    want, share = whitened_by_hand(whole, fit)
    ids = [i for i, _, _ in rows]
    table = got.pivot(index="vec_id", columns="component", values="whitened")
    assert sorted(table.index) == sorted(ids) and len(got) == len(ids) * want.shape[1]
    table = table.loc[ids].to_numpy()
    np.testing.assert_allclose(table * np.sign((table * want).sum(axis=0)), want, atol=1e-8)
    np.testing.assert_allclose(got.groupby("component").explained.first(), share, rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    assert set(got.n) == {len(fit)}
    n, sums = len(fit), fit.sum(axis=0).astype(np.int64)
    want = ((n * whole.astype(np.int64) - sums) ** 2).sum(axis=1)
    assert dict(zip(ids, want)) == dict(zip(got.vec_id, got.deviation))


def test_whitening_of_flat_and_empty_tables(spark):
    assert whitening.whitened(frame(spark, unusable())).isEmpty()
    assert whitening.whitened(frame(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).isEmpty()
    # One direction has variance: one component. A row without id stays.
    line = [(None, [0.0, 1.0], 0), (2, [1.0, 1.0], 0), (3, [2.0, 1.0], 0), (4, [3.0], 0)]
    got = whitening.whitened(frame(spark, line)).orderBy("vec_id").collect()
    assert [(r.vec_id, r.component) for r in got] == [(None, 1), (2, 1), (3, 1)]
    np.testing.assert_allclose(np.abs([r.whitened for r in got]), [1.5**0.5, 0, 1.5**0.5], atol=1e-12)


@pytest.mark.parametrize("size", [1 << 14, 1 << 20, 1 << 22])
def test_whitening_with_large_numbers(spark, size):
    """Deviations stay exact; beyond a long they are NULL."""
    rows = [(i, [float(size) * (i % 5), float(i * i)], 0) for i in range(40)]
    got = whitening.whitened(frame(spark, rows)).collect()
    whole = [[64 * int(c) for c in v] for _, v, _ in rows]
    n, sums = 40, [sum(v[d] for v in whole) for d in range(2)]
    want = {i: sum((n * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(whole)}
    assert {r.vec_id: r.deviation for r in got} == {i: v if v < 1 << 63 else None for i, v in want.items()}
    assert got[0].identity_error < 1e-9


# --- nearest vectors ---------------------------------------------------------


def nearest_by_hand(rows, queries, nearest=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=float)
    result = {}
    for q, v in queries:
        score = (x * np.array(v, dtype=float)).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:nearest]
        result[q] = [(int(ids[j]), score[j]) for j in order]
    return result


def found_by(df):
    result = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r.rank == len(result.setdefault(r.query_id, [])) + 1
        result[r.query_id].append((r.vec_id, r.score))
    return result


def test_nearest_recall_and_scores(spark):
    x = vectors(5, 6000, 24, spread=False) * np.random.default_rng(1).uniform(0.2, 5, 6000)[:, None]
    rows = [(i, v) for i, v in enumerate(x)]
    got = found_by(hnsw.nearest_vectors(frame(spark, [(i, v, 0) for i, v in rows], 5), shard_rows=1000))
    want = nearest_by_hand(rows, rows[::20])
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 20 * len(want)
    for q in got:
        assert len(got[q]) == 20 and got[q] == sorted(got[q], key=lambda r: (-r[1], r[0]))
        np.testing.assert_allclose([s for _, s in got[q]], [x[q] @ x[i] for i, _ in got[q]], rtol=1e-12)


def test_nearest_of_many_copies(spark):
    """A vector that a third of the rows share: the copies with the least ids come first."""
    x = vectors(6, 200, 8, spread=False)
    rows = [(i, v) for i, v in enumerate(x)] + [(1000 + i, x[0]) for i in range(300)]
    rows = rows[::-1]
    got = found_by(hnsw.nearest_vectors(frame(spark, [(i, v, 0) for i, v in rows], 4), least_shards=3))
    want = nearest_by_hand(rows, [r for r in rows if r[0] % 20 == 0])
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_nearest_edge_cases(spark):
    assert hnsw.nearest_vectors(frame(spark, unusable())).isEmpty()
    rows = [(0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (1, [2.0, 0.0], 0), (1, [3.0, 0.0], 0), (2, [-1.0, 0.0], 0)]
    rows += [(20, [0.0, 0.0], 0), (40, [1.0], 0), (None, [9.0, 9.0], 0), (3, [1e200, 1.0], 0), (60, [1e-200, 0.0], 0)]
    got = found_by(hnsw.nearest_vectors(frame(spark, rows + unusable())))
    # Equal rows count once, the better of two vectors of an id counts, lengths don't mix.
    assert got[0] == [(3, 1e200), (1, 3.0), (60, 1e-200), (2, -1.0)]
    assert [i for i, _ in got[60]] == [3, 1, 0, 2]
    assert 20 not in got and 40 not in got


def test_nearest_with_queries_of_their_own(spark):
    rows = [(i, v, 0) for i, v in enumerate(vectors(8, 150, 6))]
    asked = [(500, [1.0] * 6, 0)]
    got = found_by(hnsw.nearest_vectors(frame(spark, rows), frame(spark, asked), nearest=3))
    want = nearest_by_hand([r[:2] for r in rows], [r[:2] for r in asked], 3)
    assert [i for i, _ in got[500]] == [i for i, _ in want[500]]


def test_graph_compares_a_pair_once_and_sorts_out_only_full_lists(monkeypatch):
    """A walk leaves out neighbours it has seen, and a list with room takes reverse links as they are."""
    work = {"compared": 0, "sorted": 0}

    def counted(name, kind, size):
        plain = getattr(hnsw.Graph, name, None)

        def run(graph, *args):
            work[kind] += size(*args)
            return plain(graph, *args)

        monkeypatch.setattr(hnsw.Graph, name, run, raising=False)

    counted("_sims", "compared", lambda rows, ids: ids.size)
    counted("_pair_sims", "compared", lambda rows, row, ids: len(ids))
    counted("_spread", "sorted", lambda ids, sims, count: len(ids))
    x = vectors(11, 4000, 12, spread=False).astype(np.float32)
    graph = hnsw.Graph(x)
    assert work["compared"] < 1200 * len(x) and work["sorted"] < 4 * len(x)
    work["compared"] = 0
    found = graph.search(x[::10], 96)
    assert work["compared"] < 1700 * len(found)
    want = np.argsort(-(x[::10] @ x.T), axis=1)[:, :20]
    assert sum(len(set(f[:20]) & set(w)) for f, w in zip(found, want)) > 0.95 * want.size
    for layer in graph.layers:
        for node, links in enumerate(layer):
            kept = links[links >= 0]
            assert len(set(kept)) == len(kept) and node not in kept
            assert (links[len(kept) :] == -1).all()


# --- hard negatives ----------------------------------------------------------


def negatives_by_hand(rows):
    whole = [(i, [int(np.floor(256 * float(c))) for c in v], label) for i, v, label in rows]
    result = []
    for i, v, label in whole:
        if i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in whole if j != i]
        scored.sort()
        for ps, p, _ in [r for r in scored if r[2] == label][:5]:
            fits = [r for r in scored if r[2] != label and 30 * -ps <= 100 * -r[0] <= 90 * -ps]
            result += [(i, p, n + 1, r[1], -ps, -r[0]) for n, r in enumerate(fits[:10])]
    return sorted(result)


def mined(df):
    return sorted(map(tuple, hard.hard_negatives(df).collect()))


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard, "BLOCK", 8)  # several blocks of anchors and rows
    x = vectors(9, 900, 6, spread=False)
    rows = [(i, v, int(i % 3)) for i, v in enumerate(x)]
    rows += [(100 * i, v, 1) for i, v in enumerate(vectors(10, 20, 6), 10)]
    # Ties: a vector that a third of the rows share, under both labels.
    rows += [(5001 + i, x[7], i % 2) for i in range(400)]
    want = negatives_by_hand(rows)
    assert len(want) > 500
    assert mined(frame(spark, rows + [(9001, None, 1), (9002, [None] * 6, 1), (9003, [NAN] * 6, 1), (9006, x[3], None)], 5)) == want


def test_hard_negatives_with_large_numbers(spark):
    """Products beyond what doubles hold exactly."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(0, 32_000, 256).astype(float), i % 2) for i in range(60)]
    rows += [(200 + i, rows[i][1] + (np.arange(256) == 1) / 256, i % 2) for i in range(60)]
    want = negatives_by_hand(rows)
    assert want and mined(frame(spark, rows)) == want


def test_hard_negatives_edge_cases(spark):
    assert mined(frame(spark, unusable())) == []
    assert mined(frame(spark, [(100, [1.0, 0.0], 0), (1, [0.5, 0.0], 1)])) == []  # no positive
    rows = [(100, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [-1.0, 0.0], 0), (3, [0.5, 0.0], 1), (4, [0.9, 0.0], 1)]
    rows += [(5, [0.0, 0.0], 0), (6, [0.0, 1.0], 1), (7, [0.5], 1), (8, [1e30, 0.0], 1), (None, [0.5, 0.0], 1)]
    want = [(100, 1, 1, 4, 65536, 58880), (100, 1, 2, 3, 65536, 32768), (100, 5, 1, 6, 0, 0)]
    assert mined(frame(spark, rows + rows[3:5] + [(100, [1.0, 0.0], 0)])) == want


# --- helpers -----------------------------------------------------------------


def test_vectors_of_lists():
    import pyarrow as pa

    lists = pa.array([[1, 2], None, [3], [], [4, None], [5, 6]], pa.list_(pa.float32()))
    got = {m.shape[1]: (rows.tolist(), m.tolist()) for rows, m in matrices(lists.slice(0))}
    assert got == {1: ([2], [[3]]), 2: ([0, 5], [[1, 2], [5, 6]])}
    assert [r.tolist() for r, _ in matrices(lists.slice(2))] == [[0], [3]]
    x = np.array([[1, -2], [40_000, 3]])
    parts = {width: (rows.tolist(), values) for rows, width, values in packed(x)}
    assert {w: r for w, (r, _) in parts.items()} == {2: [0], 4: [1]}
    assert unpacked(parts[4][1][0].as_py(), 4, 2).tolist() == [[40_000, 3]]
    assert len(binary(np.zeros((0, 3), np.int16))) == 0
