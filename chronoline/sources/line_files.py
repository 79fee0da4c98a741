"""Line-protocol files whose quoted strings hold line breaks.

A text reader cuts such a record at every break.  Here the cuts are undone: each line
is a function of the state before it (outside or inside a quoted string) to the state
after it.  These functions compose associatively, so

1. a pass over the lines gives one function for each file block (the split that a task
   reads), in line order;
2. a scan over the blocks of a file gives the state at the start of each;
3. a second pass joins the lines of a record inside its block, and passes the parts of
   records that go over a block's end on, at most two a block; those alone are shuffled.

Only field values open strings: a quote in a measurement, tag or comment is plain text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoline.functions.codec import _FVAL, _MEAS, _NAME
from chronoline.session import scratch_path

SENT_BLOCKS = 1_000_000     # most open blocks whose states are sent to every task

_OPEN = r'(?:[^"\\]++|\\.)*+\\?'                    # the rest of a line inside a string
_FIELDS_OPEN = rf'(?:{_NAME}={_FVAL},)*+{_NAME}="'   # fields up to one whose string stays open
# A record's first line that ends inside a string, and a line inside one that ends inside one.
OPENS_RE = rf"(?s)^(?!#){_MEAS}(?:,{_NAME}={_NAME})*+ {_FIELDS_OPEN}{_OPEN}\z"
STAYS_RE = rf'(?s)^{_OPEN}(?:",{_FIELDS_OPEN}{_OPEN})?\z'


def read_line_files(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Lines of text files with their place: ``value, file, block``.  Carriage returns
    stay, so that those inside strings are kept; decoding takes off a last one."""
    reader = spark.readStream if stream else spark.read
    return (reader.schema("value STRING").option("lineSep", "\n").text(path)
            .select("value", F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block")))


def join_records(lines: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``value`` (and ``keep``, of its first line): one row for each record, line breaks
    inside quoted strings included.  ``lines`` is as from :func:`read_line_files`, its
    rows in the order of the file inside each block.

    A string that no later line of its file closes opens nothing: its lines are taken one
    by one.  Lines that fit no record stay lines, for :func:`bad_lines` to name.  A record
    must fit in a task; files may have any number of blocks.
    """
    spark, keep = lines.sparkSession, list(keep or [])
    functions, assemble = _passes(keep)
    quoted = F.col("value").contains('"')
    coded = lines.select(
        "value", "file", "block", *keep,
        (F.when(quoted & F.col("value").rlike(OPENS_RE), 1).otherwise(0)
         + F.when(~quoted | F.col("value").rlike(STAYS_RE), 2).otherwise(0)).cast("tinyint").alias("code"))
    path = scratch_path(spark, "open-blocks")
    per_block = coded.select("file", "block", "code").mapInArrow(
        functions, "file string, block long, f0 int, f1 int, t0 int, t1 int")
    _open_blocks(per_block).write.parquet(path)
    blocks = spark.read.parquet(path)
    n_open, n_across = blocks.agg(F.count("*"), F.count_if("across")).first()

    types = dict(lines.dtypes)
    schema = ", ".join(["value string", "file string", "block long", "begin long",
                        *[f"`{k}` {types[k]}" for k in keep]])

    def assembled(states: DataFrame, how: str) -> DataFrame:
        states = states.select("file", "block", "entry", "lost", "alone", "begin")
        if n_open <= SENT_BLOCKS:
            at = coded.join(F.broadcast(states), ["file", "block"], how)
        else:       # the shuffle loses the order of the lines
            at = (coded.withColumn("_i", F.monotonically_increasing_id()).join(states, ["file", "block"], how)
                  .repartition("file", "block").sortWithinPartitions("file", "block", "_i"))
        return at.select("value", "file", "block", "code", "entry", "lost", "alone", "begin",
                         *keep).mapInArrow(assemble, schema)

    whole = assembled(blocks, "left").where("begin IS NULL").select("value", *keep)
    if not n_across:
        return whole
    parts = assembled(blocks.where("across"), "inner").where("begin IS NOT NULL")
    order = F.sort_array(F.collect_list(F.struct("block", "value")))
    return whole.unionByName(
        parts.groupBy("file", "begin")
        .agg(F.array_join(F.transform(order, lambda p: p["value"]), "\n").alias("value"),
             *[F.min_by(k, "block").alias(k) for k in keep])
        .select("value", *keep))


def _open_blocks(per_block: DataFrame) -> DataFrame:
    """States of the blocks that begin or end inside a string: ``entry`` (1: begins
    inside), ``begin`` (block in which the string open at its start began), ``lost`` (the
    string open at its end is never closed), ``alone`` (all of the block lies in such a
    string), ``across`` (a record goes over its start or end).

    ``f0, f1`` are the states at a block's end and ``t0, t1`` whether some line leaves it
    outside, each for a start outside and inside."""
    w = Window.partitionBy("file").orderBy("block")
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    swap = F.when(F.col("f0") > F.col("f1"), 1).otherwise(0)
    b = per_block.withColumn("swaps", F.sum(swap).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    fixed = F.last(F.when(F.col("f0") == F.col("f1"), F.struct(F.col("f0").alias("s"), "swaps")), True).over(before)
    b = b.withColumn("fixed", fixed).withColumn("n", F.col("swaps") - swap)
    entry = F.when(F.col("fixed").isNull(), F.col("n") % 2).otherwise(
        (F.col("fixed.s") + F.col("n") - F.col("fixed.swaps")) % 2)
    b = b.withColumn("entry", entry.cast("int"))
    b = b.withColumn("exit", F.when(F.col("entry") == 1, F.col("f1")).otherwise(F.col("f0")))
    b = b.withColumn("touch", F.when(F.col("entry") == 1, F.col("t1")).otherwise(F.col("t0")))
    begins = (F.col("exit") == 1) & ((F.col("entry") == 0) | (F.col("touch") == 1))
    b = (b.withColumn("lost", (F.col("exit") == 1) & (F.coalesce(F.max("touch").over(after), F.lit(0)) == 0))
         .withColumn("begin", F.last(F.when(begins, F.col("block")), True).over(before)))
    alone = F.col("lost") & (F.col("entry") == 1) & (F.col("touch") == 0)
    across = ((F.col("entry") == 1) & ~alone) | ((F.col("exit") == 1) & ~F.col("lost"))
    return (b.where("entry = 1 OR exit = 1")
            .select("file", "block", "entry", "lost", "begin", alone.alias("alone"), across.alias("across")))


def _passes(keep: list[str]):
    """The two passes over Arrow batches, as closures that need no import of this package."""

    def after_each(code, entry):
        """State after each line: that of the last line that fixes it, turned by the
        swaps since.  Codes: 0 ends outside, 1 swaps, 2 keeps, 3 ends inside."""
        import numpy as np
        at = np.maximum.accumulate(np.where((code == 0) | (code == 3), np.arange(len(code)), -1))
        swaps = np.cumsum(code == 1)
        fixed = at >= 0
        base = np.where(fixed, code[at] == 3, entry).astype(np.int64)
        return (base + swaps - np.where(fixed, swaps[at], 0)) & 1

    def runs(batch):
        """``(file, block, first, last + 1)`` for each run of one block's lines."""
        import numpy as np
        names = batch.column("file").dictionary_encode()
        file, block = np.asarray(names.indices), np.asarray(batch.column("block"))
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        for a, z in zip([0, *cuts], [*cuts, len(block)]):
            yield names.dictionary[int(file[a])].as_py(), int(block[a]), int(a), int(z)

    def functions(batches):
        import numpy as np
        import pyarrow as pa
        at, state = None, None

        def row():
            names = ["file", "block", "f0", "f1", "t0", "t1"]
            kinds = [pa.string(), pa.int64()] + [pa.int32()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip((*at, *state), kinds)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            code = np.asarray(batch.column("code"))
            for file, block, a, z in runs(batch):
                if (file, block) != at:
                    if at:
                        yield row()
                    at, state = (file, block), [0, 1, 0, 0]
                for s in (0, 1):
                    after = after_each(code[a:z], state[s])
                    state[s], state[2 + s] = int(after[-1]), max(state[2 + s], int((after == 0).any()))
        if at:
            yield row()

    def assemble(batches):
        import numpy as np
        import pyarrow as pa
        at, state, begun, pending, kinds = None, 0, None, [], None

        def out(rows):
            """Rows of (value, begin, kept values) of the current block."""
            cols = [pa.array([r[0] for r in rows], pa.string()), pa.array([at[0]] * len(rows), pa.string()),
                    pa.array([at[1]] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.int64())]
            cols += [pa.array([r[2][j] for r in rows], t) for j, t in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(cols, ["value", "file", "block", "begin", *keep])

        def block_end():
            if pending and at[2]:
                return out([(v, None, k) for v, k in pending])
            return out([("\n".join(v for v, _ in pending), begun, pending[0][1])])

        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = [batch.schema.field(k).type for k in keep]
            code = np.asarray(batch.column("code"))
            for file, block, a, z in runs(batch):
                info = {c: batch.column(c)[a].as_py() for c in ("entry", "lost", "alone", "begin")}
                if at is None or (file, block) != at[:2]:
                    if pending:
                        yield block_end()
                    at, pending, state = (file, block, bool(info["lost"])), [], info["entry"] or 0
                    begun = info["begin"]
                if info["alone"]:
                    after = before = np.zeros(z - a, np.int64)
                else:
                    after = after_each(code[a:z], state)
                    before = np.concatenate([[state], after[:-1]])
                    state = int(after[-1])
                single = np.flatnonzero((before == 0) & (after == 0)) + a
                if len(single):
                    t = batch.take(pa.array(single))
                    none = pa.nulls(len(single), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [t.column("value"), t.column("file"), t.column("block"), none,
                         *[t.column(k) for k in keep]], ["value", "file", "block", "begin", *keep])
                joined = []
                for i in np.flatnonzero((before == 1) | (after == 1)):
                    if before[i] == 0:
                        begun = block
                    kept = [batch.column(k)[a + int(i)].as_py() for k in keep]
                    pending.append((batch.column("value")[a + int(i)].as_py(), kept))
                    if after[i] == 0:
                        here = None if begun == block else begun
                        joined.append(("\n".join(v for v, _ in pending), here, pending[0][1]))
                        pending = []
                if joined:
                    yield out(joined)
        if pending:
            yield block_end()

    return functions, assemble
