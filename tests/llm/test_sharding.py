import zlib

from chronoline.llm.sharding import WHOLE_GROUP, shard
from tests.conftest import SF01
from tests.llm.conftest import frame


def _check(rows, docs, n, tolerance):
    want = sorted((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    sizes, slots = {}, {}
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < n
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    target = sum(sizes.values()) / n
    assert all(abs(sizes.get(k, 0) - target) <= tolerance for k in range(n)), sizes


def test_laws_and_slots(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    widest = max(len((t or "").encode()) for _, t in plain) + 8
    rows = shard(docs).collect()
    _check(rows, plain, 24, 2 * widest)
    assert sorted(map(tuple, shard(docs.repartition(13)).collect())) == sorted(map(tuple, rows))


def test_hot_text_is_spread_and_small_groups_stay_whole(spark):
    """A third of all rows have one text; pairs of equal texts stay together."""
    docs = [(i, "same text") for i in range(4000)] + [(5000 + i, f"text number {i // 2}") for i in range(8000)]
    rows = shard(frame(spark, docs), 8).collect()
    _check(rows, docs, 8, 60)
    total = sum(r["size"] for r in rows)
    where = {}
    for r in rows:
        where.setdefault(r["text_crc32"], []).append(r["shard"])
    small = [s for s in where.values() if len(s) * 30 < WHOLE_GROUP * total / 8]
    assert len(small) > 3900 and all(len(set(s)) == 1 for s in small)


def test_awkward_rows(spark, awkward, nothing):
    rows = shard(awkward).collect()
    assert len(rows) == awkward.count()
    assert [(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (3, 4)] == [(8, 0)] * 2
    assert shard(nothing).collect() == []
    one = shard(frame(spark, [(1, "x")])).collect()
    assert [(r["size"], r["slot"]) for r in one] == [(9, 0)]
