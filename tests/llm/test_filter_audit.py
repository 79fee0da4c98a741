"""Filter interactions against a plain replay of all orders."""

import random
import re
from collections import defaultdict
from fractions import Fraction
from itertools import permutations
from math import factorial

from chronoline.llm import filter_audit as A
from tests.llm.conftest import frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(rows):
    """The set of failed filters of each (doc_id, lang, text)."""
    first = {}
    for i, _, t in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, _, t in rows:
        t = t or ""
        w = WORD.findall(t)
        out.append({c for c, bad in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w),
            100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search(r"[#$%&*|]", t)),
            i is not None and i > first[t])) if bad})
    return out


def replay(rows, good, toxic):
    failed, out = fails(rows), []
    for part in {lang or "" for _, lang, _ in rows}:
        docs = [(i, f) for (i, lang, _), f in zip(rows, failed) if (lang or "") == part]
        shapley, steps = defaultdict(int), []
        for order in permutations("ABCDE"):
            left = list(docs)
            for step, c in enumerate(order, 1):
                gone = [d for d in left if c in d[1]]
                failing = [d for d in docs if c in d[1]]
                left = [d for d in left if c not in d[1]]
                shapley[c] += len(gone)
                steps.append((part, "".join(order), step, len(left), len(gone), len(failing) - len(gone),
                              sum(d[1] == {c} for d in docs), sum(d[0] in good for d in gone),
                              sum(d[0] in toxic for d in gone), c))
        out += [s[:-1] + (shapley[s[-1]],) for s in steps]
    return sorted(out)


def test_equals_replay(spark):
    rng = random.Random(3)
    def text():
        n = rng.choice([0, 5, 120, 130])
        w = [rng.choice([f"w{k}", f"W{k}XYZ", "same"]) for k in range(n)]
        return " \t\n".join(w) + rng.choice(["", "", "#", "|"])
    texts = [text() for _ in range(60)] + [None, "", " \n", "\x1c" + "ab " * 150]
    rows = [(i, rng.choice(["en", "de", None, ""]), rng.choice(texts)) for i in range(300)]
    rows += rows[:5] + [(None, "en", texts[0]), (None, "en", texts[0])] + [(k, "en", "copy " * 200) for k in range(900, 1050)]
    good, toxic = set(range(0, 300, 3)) | {901, 902}, set(range(0, 300, 7))
    labels = [(i, int(i in good), int(i in toxic)) for i in range(1000)] + [(None, 1, 1), (3, None, 0), (3, 0, None)]
    docs = spark.createDataFrame([(i, t, a, "x", 1) for i, a, t in rows],
                                 "doc_id long, text string, lang string, mask string, n int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = A.audit(A.failures(docs, marks))
    assert got.columns == ["part", "filter_order", "step", *A.COUNTS]
    assert sorted(tuple(r) for r in got.collect()) == replay(rows, good, toxic)


def test_awkward_and_empty(spark, awkward, nothing):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.audit(A.failures(awkward, marks)).count() == 600 * awkward.na.fill("").select("lang").distinct().count()
    assert A.audit(A.failures(nothing, marks)).count() == 0
    assert A.audit(A.failures(frame(spark, [(1, None)]), marks)).count() == 600


def test_least_squares_equals_the_definition():
    rng = random.Random(5)
    for m in (2, 3, 5):
        v = [0] + [rng.randint(0, 100) for _ in range((1 << m) - 1)]
        want = [Fraction(0)] * m
        for order in permutations(range(m)):
            s = 0
            for i in order:
                want[i] += Fraction(v[s | 1 << i] - v[s], factorial(m))
                s |= 1 << i
        assert A.shapley(v, m) == want
