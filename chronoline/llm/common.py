"""Helpers that the operators share: shared-folder checkpoints, word rules and
connected components."""

from __future__ import annotations

import gc
import re
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoline.session import shared_dir

# Fixed by the result contracts: white space between words.
SPACE = r"\x20\x09-\x0D"
_WHITE = re.compile(r"\s")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's code to the Python workers, once for each application, so
    that executors need no install of it (as ``--py-files`` does)."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        path = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(path))
        _SHIPPED.add(sc.applicationId)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop what no frame refers to any more: checkpoint files,
    shuffles, broadcasts and generated code of finished steps, which otherwise wait in
    the driver for its next full collection; and gives Arrow's free memory back."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark.sparkContext._jvm.System.gc()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the checkpoint folder that all executors share.
    Cuts the lineage; a lost executor loses nothing.  Spark's cleaner removes the
    files when the frame is no longer used (``cleanCheckpoints``)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def whole_text(col: Column | str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def count_words(text: Column) -> Column:
    """Number of maximal runs without white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def split_words(text: Column) -> Column:
    """The maximal runs without white space, as an array."""
    return F.array_remove(F.split(F.translate(text, "\t\n\x0b\f\r", "     "), " "), "")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(key: Column | str) -> Column:
    """An integer join key that Spark does not know to be partitioned already.  An
    aggregate joined by its own key is shuffled again, which is cheap; then both
    sides of the join are plain shuffles, and AQE may split the other side's hot keys."""
    return F.bitwise_not(F.bitwise_not(F.col(key) if isinstance(key, str) else key))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` for every node of the undirected ``edges``; the
    component is the smallest node id reachable.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): each is
    a partial aggregation (the smallest neighbour) and a join of edges with it,
    so a node with very many neighbours is a skewed join side that AQE splits,
    never a gathered group.  Rounds end when all components are stars; every
    round is written to the checkpoint folder.  No edges: no rows.
    """
    e = (edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).filter("u <> v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = cut(e)
    while not _is_stars(e):
        e = cut(_small_star(_large_star(e)))
        release(edges.sparkSession)
    roots = e.select(F.col("v").alias("node")).distinct()
    return (e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
            .unionByName(roots.select("node", F.col("node").alias("component")))
            .groupBy("node").agg(F.min("component").alias("component")))


def _is_stars(e: DataFrame) -> bool:
    """Whether every node has one edge to a smaller one, which has none itself."""
    n = e.agg(F.count("*").alias("all"), F.count_distinct("u").alias("nodes")).first()
    if n["all"] != n["nodes"]:
        return False
    tops = e.select(fresh("v").alias("top")).distinct()
    return e.join(tops, F.col("u") == F.col("top"), "left_semi").isEmpty()


def _large_star(e: DataFrame) -> DataFrame:
    """Each neighbour above u is linked to the smallest of u's neighbourhood; an edge
    may repeat, at most as often as there are edges."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy(F.col("u").alias("m_u")).agg(F.min("v").alias("m"))
    low = low.select(fresh("m_u").alias("m_u"), F.least("m", "m_u").alias("m"))
    return (both.join(low, F.col("u") == F.col("m_u")).filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(e: DataFrame) -> DataFrame:
    """Every neighbour below u, and u itself, is linked to the smallest of them."""
    low = e.groupBy(F.col("u").alias("m_u")).agg(F.min("v").alias("m"))
    keyed = low.select(fresh("m_u").alias("m_u"), "m")
    moved = (e.join(keyed, F.col("u") == F.col("m_u")).filter("v <> m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.unionByName(low.select(F.col("m_u").alias("u"), F.col("m").alias("v"))).distinct()


def text_blocks(text: str, size: int = 1 << 20):
    """A text in parts of about ``size`` characters that end at white space, so
    that lists of a part's words stay small however long the text is."""
    at = 0
    while len(text) - at > size:
        m = _WHITE.search(text, at + size)
        if not m:
            break
        yield text[at:m.end()]
        at = m.end()
    yield text[at:] if at else text
