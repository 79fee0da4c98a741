"""Records whose quoted strings hold line breaks: joined over blocks, against a plain
scan of each file's characters."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from chronoline.functions.codec import LINE_RE, bad_lines, decode_lines, encode_lines
from chronoline.operators.points import to_points
from chronoline.sources import store
from chronoline.sources.line_files import join_records, read_line_files
from chronoline.streaming.sink import write_stream

KEY = re.compile(r"(?:[^, \\\n]|\\.)+(?:,(?:[^,= \\\n]|\\.)+=(?:[^,= \\\n]|\\.)+)* ")
NAME = re.compile(r"(?:[^,= \\\n]|\\.)+=")
PLAIN = re.compile(r'[^," \n]+')
STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.S)
PIECES = ['cpu v=1 5', 'cpu,h=a"b v="x" 6', 'cpu v="a', 'b" 7', '', 'tail\\"', 'mid "', 'end",w="again', '"', '# c="',
          'cpu v="p\\\\" 8', 'é ü"', 'cpu v="\\', 'x\r', 'cpu s="1",t="', 'no line at all', 'cpu v="zero', '\\" "']


def plain_records(text):
    """The records of one file, character by character."""
    lines = text.split("\n")
    if lines and lines[-1] == "":
        lines.pop()
    starts = [0]
    for line in lines:
        starts.append(starts[-1] + len(line) + 1)
    text, i, out = "\n".join(lines), 0, []
    while i < len(lines):
        end = i + _breaks(text, starts[i])
        out += ["\n".join(lines[i:end + 1])] if end < len(lines) else lines[i:]
        i = end + 1
    return out


def _breaks(text, p):
    """Breaks inside the strings of the record at ``p``; very many if one is never closed."""
    at, k = p, None
    if text[p:p + 1] == "#" or not (k := KEY.match(text, p)):
        return 0
    p = k.end()
    while m := NAME.match(text, p):
        p = m.end()
        if text[p:p + 1] == '"':
            if not (s := STRING.match(text, p)):
                return 1 << 40
            p = s.end()
        elif v := PLAIN.match(text, p):
            p = v.end()
        else:
            break
        if text[p:p + 1] != ",":
            break
        p += 1
    return text.count("\n", at, p)


@pytest.fixture
def block_bytes(spark):
    """Sets the size of file blocks for one test."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    yield lambda n: [spark.conf.set(c, str(n)) for c in names]
    for n, v in before.items():
        spark.conf.set(n, v)


def _write(folder, texts):
    os.makedirs(folder)
    for i, t in enumerate(texts):
        with open(os.path.join(folder, f"f{i:03}.txt"), "w", newline="", encoding="utf-8") as f:
            f.write(t)


def _local(tmp_store):
    return tmp_store.removeprefix("file:")


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_records_as_by_characters(spark, tmp_store, block_bytes, size):
    rng = random.Random(size)
    texts = ["\n".join(rng.choices(PIECES, k=rng.randint(0, 25))) + rng.choice(["", "\n"]) for _ in range(30)]
    texts += ["", "\n", 'cpu v="never\nclosed\ncpu v=1 2\n', 'cpu v="' + "long\n" * 300 + '" 9\ncpu v=1 2']
    _write(_local(tmp_store), texts)
    block_bytes(size)
    got = join_records(read_line_files(spark, tmp_store)).collect()
    want = [r for t in texts for r in plain_records(t)]
    assert sorted(r.value for r in got) == sorted(want)
    assert sum("\n" in w for w in want) > 20
    assert any(re.search(LINE_RE.replace("\\z", "\\Z"), w) and "\n" in w for w in want)


def test_beyond_the_broadcast_bound(spark, tmp_store, block_bytes, monkeypatch):
    texts = ['cpu v="a\n\nb",w="\n" 1\n' * 40, 'cpu v="x\ny\n' + "cpu v=1 2\n" * 9]
    _write(_local(tmp_store), texts)
    block_bytes(11)
    monkeypatch.setattr("chronoline.sources.line_files.SENT_BLOCKS", 0)
    lines = read_line_files(spark, tmp_store).withColumn("at", F.lit("2024-01-02 03:04:05.678901").cast("timestamp"))
    got = join_records(lines, ["at"]).select("value", F.col("at").cast("string").alias("at")).collect()
    assert sorted(r.value for r in got) == sorted(r for t in texts for r in plain_records(t))
    assert {r["at"] for r in got} == {"2024-01-02 03:04:05.678901"}


def test_round_trip_and_bad_records(spark, tmp_store, block_bytes):
    df = spark.createDataFrame([(i, f'l1 "{i}"\n\\l2\\\r\n,x="{i}\n') for i in range(50)], "t long, s string")
    pts = to_points(df, "m", [], ["s"], "t")
    encode_lines(pts).unionByName(spark.createDataFrame([("m s=\"a\nb\" junk 1",)], "value string")).write.text(tmp_store)
    block_bytes(50)
    rows = join_records(read_line_files(spark, tmp_store))
    back = decode_lines(rows).select(F.col("time_ns").alias("t"), F.col("value_string").alias("s"))
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    assert [(r.value, r.reason) for r in bad_lines(rows).collect()] == [('m s="a\nb" junk 1', "syntax")]


def test_stream_keeps_breaks(spark, tmp_store, block_bytes):
    texts = ['m s="a\nb" 1\nm s="c" 2\n', 'm s="\n\nd",u=2i 3\n\nm s="open\n']
    _write(_local(tmp_store) + "/in", texts)
    block_bytes(5)
    q = write_stream(read_line_files(spark, f"{tmp_store}/in", stream=True), f"{tmp_store}/st", "b",
                     f"{tmp_store}/ck", trigger={"availableNow": True}, line_breaks=True)
    q.awaitTermination()
    assert q.exception() is None
    got = store.read_points(spark, f"{tmp_store}/st", "b", "m").select("time_ns", "value_string", "value_long").collect()
    assert {(r[0], r[1] if r[1] is not None else r[2]) for r in got} == {(1, "a\nb"), (2, "c"), (3, "\n\nd"), (3, 2)}
    with pytest.raises(ValueError, match="file"):
        write_stream(spark.readStream.schema("value STRING").text(f"{tmp_store}/in"), f"{tmp_store}/st", "b",
                     line_breaks=True)
