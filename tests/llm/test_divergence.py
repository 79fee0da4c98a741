"""Term divergence: packing, radix order and the whole report against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from chronoline.llm import divergence as D
from tests.llm.conftest import frame

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, top=10):
    """``rows``: (lang, source, text)."""
    rows = [(a or "", b or "", t or "") for a, b, t in rows]
    seen, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = TERM.findall(text.translate(LOWER))
        seen[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang, source in counts:
        kept = [t for t, n in seen[lang].items() if n >= least]
        share = {}
        for g in [g for g in counts if g[0] == lang]:
            n = sum(counts[g][t] for t in kept)
            share[g[1]] = {t: 1 + 10**9 * (counts[g][t] + 2) // (n + 2 * len(kept)) for t in kept}
        n = sum(counts[g][t] for g in counts if g[0] == lang for t in kept)
        whole = {t: 1 + 10**9 * (sum(counts[g][t] for g in counts if g[0] == lang) + 2) // (n + 2 * len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        mine = share[source]
        pairs = [(-sum(f(mine[t], o[t]) for t in kept), s.encode(), s) for s, o in share.items() if s != source]
        terms = [(-f(mine[t], whole[t]), t.encode(), t) for t in kept if counts[lang, source][t] and mine[t] > whole[t]]
        out += [(lang, source, "pair", s, -v, i) for i, (v, _, s) in enumerate(sorted(pairs), 1)]
        out += [(lang, source, "term", s, -v, i) for i, (v, _, s) in enumerate(sorted(terms)[:top], 1)]
    return sorted(out)


def words(rng):
    pool = ["a", "ab", "Straße", "eightcha", "ninechars", "sixteencharacte", "sixteencharacter", "seventeencharacte",
            "日本語", "日本語のテキスト空白なし", "x" * 40, "x" * 39 + "y", "x" * 200, "İstanbul", "naïve", "ÀB", "àb"]
    return " ".join(rng.choice(pool) + rng.choice(["", ",", "1", "-"]) for _ in range(rng.randint(0, 30)))


def table(spark, rows):
    return spark.createDataFrame([(n, a, b, t, "x", "x", 1) for n, (a, b, t) in enumerate(rows)],
                                 "doc_id long, lang string, source string, text string, term string, sid string, v int")


@pytest.mark.parametrize("tile,block,piece", [(128, 4096, 1 << 22), (2, 3, 300)])
def test_equals_plain_python(spark, tile, block, piece):
    rng = random.Random(7)
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["s0", "s0", "s1", "s2", "s10", None, "z"]), words(rng)) for _ in range(400)]
    rows += [("en", "s0", None), ("en", "s0", ""), ("fr", "alone", "1 2 3"), ("fr", None, None), ("en", "s1", "ab " * 5000 + "x" * 40)]
    rows += [("en", "s1", "hot copy ab")] * 150
    got = D.divergence(table(spark, rows), piece=piece, tile=tile, block=block)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_radix_order_is_stable():
    rng = np.random.default_rng(1)
    w = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    w[::3] = w[0]
    assert (D.radix_order(w) == np.argsort(w, kind="stable")).all()
    assert len(D.radix_order(w[:0])) == 0


def test_awkward_and_empty(spark, awkward, nothing):
    got = D.divergence(awkward, least_docs=2).collect()
    assert {r["lang"] for r in got} == {"en", "", "de"}
    assert D.divergence(nothing).collect() == []
    assert D.divergence(frame(spark, [(1, None)])).collect() == []   # one source: no other, no terms


def test_rows_of_a_piece_equal_plain_counts():
    """Terms of all length buckets, as columns of one batch for each bucket."""
    import random
    import re
    from collections import Counter

    import pyarrow as pa

    from chronoline.llm.divergence import _piece_rows
    rng = random.Random(4)
    words = ["a", "Straße", "abcdefgh", "abcdefghi", "abcdefghijklmnop", "Abcdefghijklmnopq", "日本語のテキスト", "x" * 40, "y" * 300]
    docs = [(rng.choice(["en", "de", ""]), rng.choice(["s0", "s1"]), " ".join(rng.choices(words, k=rng.randrange(30))))
            for _ in range(60)]
    n, held = Counter(), Counter()
    for lang, source, text in docs:
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        n.update((lang, source, t.encode()) for t in terms)
        held.update((lang, source, t.encode()) for t in set(terms))
    args = [pa.array([d[0] for d in docs]), pa.array([d[1] for d in docs]), pa.array([d[2].encode() for d in docs])]
    batches = list(_piece_rows(*args, 1 << 20))
    assert all(isinstance(b, pa.RecordBatch) for b in batches)
    got = {tuple(r.values())[:3]: (r["n"], r["docs"]) for b in batches for r in b.to_pylist()}
    assert got == {k: (n[k], held[k]) for k in n} and sum(b.num_rows for b in batches) == len(n)
