import random

import numpy as np
import pytest

from chronoline.llm import setsketch
from chronoline.llm.common import connected_components
from chronoline.llm.setsketch import REGISTERS, band_rows, estimate, near_duplicates, registers, shingle_set
from tests.conftest import SF01
from tests.llm.conftest import frame


def brute(docs, k=3, percent=85):
    sets, parent = {}, {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[a:a + k]) for a in range(max(1, len(w) - k + 1))) if w else frozenset()
        parent[i] = i

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(i for i in sets if i is not None)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            lo, hi = sorted((len(sets[a]), len(sets[b])))
            if lo and 100 * lo >= percent * hi and root(a) != root(b):
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (lo + hi - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {i: (len(sets[i]), root(i) if i is not None else None) for i in sets}


def _check(df, docs, **how):
    got = near_duplicates(df, **how).collect()
    want = brute(docs, **how)
    assert len(got) == df.count()
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r
        assert r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"])


def test_given_documents(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    _check(df, [(r["doc_id"], r["text"]) for r in df.collect()])


@pytest.mark.parametrize("tile,chunk", [(512, 64), (8, 3)])
def test_large_group_of_near_copies(spark, monkeypatch, tile, chunk):
    """Copies whose similarity to each other lies on both sides of the threshold."""
    monkeypatch.setattr(setsketch, "TILE", tile)
    monkeypatch.setattr(setsketch, "CHUNK", chunk)
    r = random.Random(9)
    base = [f"w{r.randrange(5000)}" for _ in range(150)]
    docs = []
    for i in range(160):
        w = list(base)
        for _ in range(r.randrange(5)):
            w[r.randrange(len(w))] = f"x{r.randrange(10 ** 6)}"
        docs.append((1000 + i, " ".join(w)))
    docs += [(i, " ".join(f"y{r.randrange(9999)}" for _ in range(60))) for i in range(40)]
    docs += [(2000 + i, docs[3][1].upper()) for i in range(30)]
    _check(frame(spark, docs), docs)
    _check(frame(spark, docs), docs, k=5, percent=80)


def test_awkward_rows(awkward, nothing):
    _check(awkward, [(r["doc_id"], r["text"]) for r in awkward.collect()])
    assert near_duplicates(nothing).collect() == []


def test_registers_merge_and_estimate():
    r = np.random.default_rng(2)
    s = np.unique(r.integers(0, 2 ** 63, 700, dtype=np.uint64))
    a, b = s[:600], s[100:]
    assert (np.maximum(registers(a), registers(b)) == registers(s)).all()
    assert (registers(a) == registers(a[::-1].copy())).all()
    err = []
    for _ in range(200):
        s = r.integers(0, 2 ** 63, 540, dtype=np.uint64)
        x, y = np.unique(s[:500]), np.unique(s[40:])
        err.append(estimate(registers(x)[None], registers(y)[None], np.array([500]), np.array([500]))[0] - 460 / 540)
    assert abs(np.mean(err)) < 0.01 and np.std(err) < 1.4 * np.sqrt(0.85 * 0.15 / REGISTERS)


def test_bands_reach_their_recall():
    for t in (0.8, 0.85):
        rows = band_rows(t)
        assert 1 - (1 - t ** rows) ** (REGISTERS // rows) >= setsketch.BAND_RECALL


def test_shingles():
    assert len(shingle_set("a b", 3)) == len(shingle_set("A\x0bB ", 3)) == 1
    assert len(shingle_set(" \x0c", 3)) == 0
    assert len(shingle_set("a b", 3)) == 1      # a no-break space is part of a word
    assert (shingle_set("a b c d", 3) == shingle_set("a  b\tC d", 3)).all()


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(200)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {x["node"]: x["component"] for x in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert all(got[x] == root(x) for x in got)
    assert set(got) == {x for e in edges if e[0] != e[1] for x in e}
