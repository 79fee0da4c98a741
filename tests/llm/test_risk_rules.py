"""Risk-controlled rules: statistics and cutoffs against plain Python, the guarantee on
many strata."""

import random
import re
from collections import Counter
from math import comb

from pyspark.sql import functions as F

from chronoline.llm import risk_rules as R
from tests.conftest import SF01
from tests.llm.conftest import frame
from tests.oracle_compare import compare, duck

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_stats(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    twice = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if twice[x] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines), len(lines) - len(set(lines)), len(covered))


def values(s):
    return dict(symbols=min(1000, 1000 * s[2] // s[1]), lines=1000 * s[4] // s[3],
                repeats=1000 * s[5] // s[0], lengths=min(1000, abs(100 * s[1] // s[0] - 500)))


def binomial_most(n, alpha, delta):
    c, most = 0.0, -1
    for k in range(n + 1):
        c += comb(n, k) * alpha**k * (1 - alpha)**(n - k)
        if c > delta:
            break
        most = k
    return most


def plain_cuts(rows, rules, alpha, delta):
    """``rows``: (stratum, good, values)."""
    strata = {s for s, good, _ in rows if good}
    out = {}
    for s in strata:
        mine = [r for r in rows if r[0] == s]
        ng = sum(r[1] for r in mine)
        nb = len(mine) - ng
        most = binomial_most(ng, alpha / len(rules), delta / (len(strata) * len(rules)))
        for rule in rules:
            best = (0, None)
            for t in sorted({r[2][rule] for r in mine}, reverse=True):
                g = sum(r[1] for r in mine if r[2][rule] >= t)
                b = sum(not r[1] for r in mine if r[2][rule] >= t)
                if g <= most and b * ng - g * nb > best[0]:
                    best = (b * ng - g * nb, t)
            out[s, rule] = best[1]
    return out


def texts(rng, n):
    out = []
    for _ in range(n):
        w = [rng.choice(["word", "of", "a", "the", "some", "#", "<b>", "lengthier", "naïve", "日本語"]) + str(rng.randint(0, 40))
             for _ in range(rng.choice([0, 2, 3, 49, 50, 51, 200]))]
        w += rng.choice([[], w[:20], w, w[5:9] * 3]) + rng.choice([[], [], [], [f"##{k}" for k in range(60)]])
        out.append(rng.choice(["", "\n"]) + "".join(x + rng.choice([" ", "\n", "\t", "\r\n", "\x0b\x0c", "  "]) for x in w))
    return out + [None, "", " \n\n", "a\na\n a", "x x x x", "x x x", "\x1ca\x1c b\n\xa0\n\xa0\n"]


def test_statistics(spark):
    ts = texts(random.Random(2), 120) + ["tick tock " * 60_000]
    got = R.text_stats(frame(spark, list(enumerate(ts)))).collect()
    assert len(got) == len(ts)
    for r in got:
        assert tuple(r)[2:] == plain_stats(ts[r["id"]]), r["id"]


def test_verdicts_equal_plain_python(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["en", "en", "de", None]), t) for i, t in enumerate(texts(rng, 900))]
    rows += rows[:3] + [(None, "en", "some text " * 40)]
    quality = {i: int(rng.random() < (0.05 if "##" in (t or "") else 0.95)) for i, _, t in rows if i is not None and i % 5}
    labels = spark.createDataFrame(list(quality.items()) + [(None, 1), (5, None), (7, 0)], "doc_id long, quality int")
    quality[7] = max(quality[7], 0)
    docs = spark.createDataFrame([(i, t, s, "x", "x") for i, s, t in rows],
                                 "doc_id long, text string, lang string, n_words string, stratum string")
    got = R.judge(docs, labels, alpha=0.3, delta=0.2).collect()
    assert len(got) == len(rows)
    stats = {(i, s): plain_stats(t) for i, s, t in rows}
    base = {k: s[0] < 50 or 100 * s[5] > 50 * s[0] for k, s in stats.items()}
    seen = [(k[1], bool(quality[k[0]]), values(s)) for k, s in stats.items() if k[0] in quality and not base[k]]
    cuts = plain_cuts(seen, list(R.RULES), 0.3, 0.2)
    assert any(c is not None for c in cuts.values())
    want = Counter()
    for i, s, _ in rows:
        st, bad = stats[i, s], base[i, s]
        fails = [] if bad else [r for r, v in values(st).items() if cuts.get((s, r)) is not None and v >= cuts[s, r]]
        want[(i, st[0], st[1], st[2], st[4], st[5], bad, ",".join(fails), not bad and not fails)] += 1
    assert Counter(tuple(r) for r in got) == want


def test_exact_binomial_limit(spark):
    cases = [(n, a, d) for n in (1, 10, 99, 500, 1000) for a in (0.01, 0.2) for d in (0.001, 0.05)]
    for n, a, d in cases:
        got = spark.range(1).select(R.most_rejections(F.lit(n).cast("long"), a, F.lit(d))).first()[0]
        assert got == binomial_most(n, a, d), (n, a, d)


def test_limit_holds_in_all_strata(spark):
    """Rule values without any signal: 200 strata, 2000 good rows each; none may get a
    cutoff that rejects over alpha of the good population."""
    rows = (spark.range(200 * 2600).select((F.col("id") % 200).cast("string").alias("stratum"),
                                           (F.col("id") < 200 * 2000).alias("good"),
                                           (F.rand(3) * 1000).cast("int").alias("a"),
                                           (F.rand(5) * 1000).cast("int").alias("b")))
    cuts = R.calibrate(rows, ["a", "b"], alpha=0.1, delta=0.05).collect()
    assert len(cuts) > 100
    over = [r for r in cuts if sum((1000 - r[c]) / 1000 for c in ("c_a", "c_b") if r[c] is not None) > 0.1]
    assert not over


def test_awkward_and_empty(spark, awkward, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = R.judge(awkward, none).collect()
    assert len(got) == awkward.count() and not any(r["kept"] for r in got)
    assert R.judge(nothing, none).count() == 0
    assert not R.judge(frame(spark, [(1, None)]), none).first()["kept"]


def test_sql_with_many_labels(spark, tmp_path):
    """The query's SQL where cutoffs exist: every text of sf0.01 under many ids."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    times = spark.range(4).select((F.col("id") * 100_000).alias("add"))
    more = docs.crossJoin(times).withColumn("doc_id", F.col("doc_id") + F.col("add")).drop("add")
    marks = labels.crossJoin(times).withColumn("doc_id", F.col("doc_id") + F.col("add")).drop("add")
    got = R.judge(more, marks)
    assert got.filter("failed_rules <> ''").count() > 0
    con = duck(SF01)
    con.register("more", more.toArrow())
    con.register("marks", marks.toArrow())
    sql = R.OP11_SQL.replace("FROM documents", "FROM more").replace("FROM labels", "FROM marks")
    ok, msg = compare(got, con, sql)
    assert ok, msg
