"""Top-k search and embedding near-duplicates, against brute force in numpy."""

import numpy as np
import pytest

from chronoline.llm import cross_polytope, topk
from chronoline.llm.cross_polytope import near_duplicates
from chronoline.llm.topk import top_k


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows],
                                 "vec_id long, embedding array<float>, rep string, n string")


def brute_top(rows, k=10, every=100, scale=1024):
    ok = [(i, tuple(int(np.floor(scale * float(np.float32(x)))) for x in v)) for i, v in rows
          if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (q, a) in enumerate(ok):
        if q is not None and q % every == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), i is None, i or 0, i) for m, (i, b) in enumerate(ok)
                       if m != n and len(a) == len(b))
            out += [(q, r, x[3], -x[0]) for r, x in enumerate(s[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("blocks", [(1024, 8192), (2, 100)])
def test_top_k(spark, monkeypatch, blocks):
    """A third of the rows are one vector, so hundreds tie; blocks cut both sides."""
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "ROW_BLOCK", blocks[1])
    r = np.random.default_rng(3)
    same = r.normal(size=8).tolist()
    rows = [(i, same if i % 3 == 0 else r.normal(size=8).tolist()) for i in range(900)]
    rows += [(1001, None), (1002, [1.0] * 7 + [None]), (1003, [float("nan")] * 8), (1100, [float("inf")] * 8),
             (1200, [0.0] * 8), (1300, []), (1400, [1.0, 2.0]), (1401, [3.0, 4.0]), (None, same), (5, rows[5][1]), (5, same), (300, rows[1][1]), (None, rows[4][1])]
    got = sorted((tuple(x) for x in top_k(frame(spark, rows)).select("query_id", "rank", "vec_id", "score").collect()), key=str)
    assert got == brute_top(rows)


def test_top_k_near_copies_of_unit_vectors(spark):
    """Over 40 near copies lie in one bin of the first pass, which the second refines."""
    r = np.random.default_rng(11)
    unit = lambda x: (x / np.linalg.norm(x)).tolist()
    seed = r.normal(size=16)
    rows = [(i, unit(r.normal(size=16))) for i in range(500)]
    rows += [(1000 + i, unit(seed + r.normal(size=16) * 0.01)) for i in range(60)]
    rows += [(2000 + i, rows[100][1]) for i in range(1, 61)]
    got = sorted((tuple(x) for x in top_k(frame(spark, rows)).select("query_id", "rank", "vec_id", "score").collect()), key=str)
    assert got == brute_top(rows)


def test_rows_that_share_an_id(spark):
    """Two vectors of one id: both are candidates, the better one is not lost."""
    rows = [(100, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.9, 0.0]), (None, [0.95, 0.0])]
    assert [tuple(x) for x in top_k(frame(spark, rows)).orderBy("rank").collect()] == brute_top(rows)
    got = near_duplicates(frame(spark, [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (None, [1.0, 0.0]), (None, [-1.0, 0.0])]))
    assert sorted((tuple(x) for x in got.collect()), key=str) == sorted(
        [(1, 2, 1, True), (1, 2, 1, True), (2, 0, 2, True), (None, 2, 1, False), (None, 0, None, True)], key=str)


def test_top_k_large_and_few(spark):
    big = [(0, [3e6, -2e6]), (1, [1e6, 5e5]), (2, [1e6, 5e5])]
    got = [tuple(x) for x in top_k(frame(spark, big)).orderBy("rank").collect()]
    assert sorted(got, key=str) == brute_top(big)
    assert top_k(frame(spark, [])).count() == 0 == top_k(frame(spark, [(1, [1.0])])).count()


def brute_links(rows, least=0.95):
    good = {n: np.array(v, np.float32).astype(float) for n, (_, v) in enumerate(rows)
            if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    near = [[m for m in good if m != n and len(good[n]) == len(good[m]) and
             good[n] @ good[m] / np.linalg.norm(good[n]) / np.linalg.norm(good[m]) >= least]
            if n in good else [] for n in range(len(rows))]
    part = list(range(len(rows)))
    while any(part[n] > part[m] for n in part for m in near[n]):
        for n in range(len(rows)):
            part[n] = min([part[n], *(part[m] for m in near[n])])
    first = {p: min((i for (i, _), q in zip(rows, part) if q == p and i is not None), default=None) for p in part}
    return sorted(((i, len(near[n]), first[part[n]], first[part[n]] == i) for n, (i, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("tile", [512, 16])
def test_near_duplicates(spark, monkeypatch, tile):
    """Copies, a large group of near copies, chains, and vectors that take no part."""
    monkeypatch.setattr(cross_polytope, "TILE", tile)
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=24).tolist()) for i in range(150)]
    seed = r.normal(size=24)
    rows += [(200 + i, (seed + r.normal(size=24) * 0.12).tolist()) for i in range(120)]
    rows += [(400 + i, rows[7][1]) for i in range(40)] + [(500, (2 * np.array(rows[9][1])).tolist())]
    step = r.normal(size=24)
    rows += [(600 + i, (seed * 3 + step * i * 0.9).tolist()) for i in range(12)]
    rows += [(700, None), (701, [0.0] * 24), (702, [float("nan")] * 24), (703, [None] + [1.0] * 23), (704, []),
             (705, [1.0]), (706, [5.0]), (707, [1e30] * 24), (708, [1e30] * 24), (3, rows[3][1]), (3, rows[4][1]), (None, rows[9][1])]
    got = sorted((tuple(x) for x in near_duplicates(frame(spark, rows)).collect()), key=str)
    want = brute_links(rows)
    missed = [(g, w) for g, w in zip(got, want) if g != w]
    assert len(got) == len(want)
    assert len(missed) <= len(want) // 200, missed[:5]   # hashing may miss a link at the border


def test_recall_at_the_threshold():
    r = np.random.default_rng(1)
    a = cross_polytope.unit(r.normal(size=(3000, 64)))
    b = r.normal(size=a.shape)
    b = cross_polytope.unit(b - (a * b).sum(1, keepdims=True) * a)
    x, y = cross_polytope.bucket_codes(a), cross_polytope.bucket_codes(0.95 * a + np.sqrt(1 - 0.95 ** 2) * b)
    assert np.mean([np.intersect1d(p, q).size > 0 for p, q in zip(x, y)]) > 0.999


def test_no_vectors(spark):
    assert near_duplicates(frame(spark, [])).count() == 0
    assert [tuple(x) for x in near_duplicates(frame(spark, [(4, None)])).collect()] == [(4, 0, 4, True)]
