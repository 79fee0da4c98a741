import re

from chronoline.llm.mixing import MAX_REPEATS, mix, mixed
from tests.llm.conftest import frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Sources in order with sizes: shares by weight 1, 2, 3, cut and shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in stopped]
        left, wsum = total - sum(stopped.values()), sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / wsum > MAX_REPEATS * sizes[s]]
        if not over:
            return {s: float(stopped[s]) if s in stopped else left * w[s] / wsum for s in names}
        stopped.update({s: MAX_REPEATS * sizes[s] for s in over})


def test_targets_and_taken(spark):
    docs = [(i, "w " * (1 + i * 37 % 50)) for i in range(1500)] + [(9000 + i, "v " * 3) for i in range(3)]
    of = [("hot", "hot", "b", "c", None)[i % 5] for i in range(1500)] + ["tiny"] * 3
    df = frame(spark, docs, sources=of)
    rows = mix(df).collect()
    sizes = {}
    for (_, t), s in zip(docs, of):
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t))
    want, source = targets(sizes), {i: s for (i, _), s in zip(docs, of)}
    taken = {}
    for r in rows:
        s = source[r["doc_id"]]
        assert abs(r["target"] - want[s]) < 1e-6 and r["source_size"] == sizes[s]
        assert r["taken"] == r["size"] * r["repeats"] and 0 <= r["repeats"] <= MAX_REPEATS
        taken[s] = taken.get(s, 0) + r["taken"]
    assert want["tiny"] == 27 == taken["tiny"]   # stopped at three times its size
    assert all(abs(taken[s] - want[s]) <= 50 for s in want)
    assert sorted(map(tuple, mix(df.repartition(7)).collect())) == sorted(map(tuple, rows))
    assert mixed(df).count() == sum(r["repeats"] for r in rows)
    assert mixed(df).columns == df.columns


def test_awkward_rows(awkward, nothing):
    rows = mix(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(r["size"] == 0 == r["taken"] for r in rows if r["doc_id"] in (3, 4, 5))
    assert mix(nothing).collect() == [] and mixed(nothing).count() == 0


def test_no_words_at_all(spark):
    rows = mix(frame(spark, [(1, ""), (2, None)])).collect()
    assert [(r["target"], r["taken"]) for r in rows] == [(0.0, 0)] * 2
