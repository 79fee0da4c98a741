"""Contiguous, byte-balanced shards from global prefix sums (operator 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoline.llm.common import cut, shuffle_partitions, whole_text

CELLS = 1024        # least number of cells of the prefix sum
WHOLE_GROUP = 0.01  # equal texts up to this share of a shard's target stay in one shard


def shard(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
          overhead: int = 8, whole_group: float = WHOLE_GROUP) -> DataFrame:
    """One row per row of ``docs``: ``id_col, size, text_crc32, law, shard, slot,
    grown_shard``.

    ``size`` is the text's UTF-8 bytes plus ``overhead``.  Rows have one global
    order: by the hash of the text, so that equal texts lie together, then by id.
    The order is dealt into cells; cell totals give each cell's offset, a running
    sum inside the cell gives each row's, and ``[0, total)`` is cut at ``n_shards``
    equal targets.  A row goes where its middle byte falls; a group of equal texts
    no larger than ``whole_group`` of a target goes as one row would, a larger one
    is cut at its rows.  So sizes differ by one row, or ``whole_group`` of a target.

    A text with more rows than an average cell holds gets several cells by id
    hash.  There are at most as many such texts as cells, and at most three times
    as many cells as planned: the broadcasts have that bound at any input size.

    Null and empty texts have ``overhead`` bytes and crc 0, and count as equal
    texts.  Repeated rows are rows of their own (equal ones are exchangeable);
    a null id is ordered first.  No rows: no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    text = whole_text(text_col)
    rows = cut(docs.select(F.col(id_col).alias("id"),
                           (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
                           F.crc32(text).alias("crc"), F.xxhash64(text).alias("h")))
    total = rows.agg(F.count("*").alias("n"), F.sum("size").alias("b")).first()
    n, n_bytes = total["n"], total["b"] or 0
    cells = max(CELLS, 4 * shuffle_partitions(spark))
    hot = (rows.groupBy("h").agg(F.count("*").alias("c")).filter(F.col("c") * cells > n)
           .select(F.col("h").alias("hot_h"), F.ceil(F.col("c") * cells / max(n, 1)).alias("parts")))
    is_hot = F.col("hot_h").isNotNull()
    keyed = rows.join(F.broadcast(hot), F.col("h") == F.col("hot_h"), "left").select(
        "id", "size", "crc", "h",
        F.struct((~is_hot).alias("light"),
                 F.when(is_hot, F.col("h")).otherwise(F.pmod("h", F.lit(cells))).alias("main"),
                 F.when(is_hot, F.pmod(F.xxhash64("id"), F.col("parts"))).otherwise(F.lit(0))
                 .cast("long").alias("part")).alias("cell"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (keyed.groupBy("cell").agg(F.sum("size").alias("cb"), F.count("*").alias("cn"))
               .select(F.col("cell").alias("o_cell"),
                       F.coalesce(F.sum("cb").over(before), F.lit(0)).alias("byte0"),
                       F.coalesce(F.sum("cn").over(before), F.lit(0)).alias("row0")))
    run = (Window.partitionBy("cell").orderBy("h", "id", "size", "crc")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    group = Window.partitionBy("cell", "h")
    target = n_bytes / n_shards
    placed = (keyed.withColumn("end", F.sum("size").over(run))
              .withColumn("nth", F.row_number().over(run.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("g_end", F.max("end").over(group))
              .withColumn("g_start", F.min(F.col("end") - F.col("size")).over(group))
              .join(F.broadcast(offsets), F.col("cell") == F.col("o_cell")))
    whole = F.col("cell.light") & (F.col("g_end") - F.col("g_start") <= F.lit(whole_group * target))
    twice_middle = (2 * F.col("byte0") + F.when(whole, F.col("g_start") + F.col("g_end"))
                    .otherwise(2 * F.col("end") - F.col("size")))
    placed = cut(placed.select(
        "id", "size", "crc", (F.col("row0") + F.col("nth") - 1).alias("at"),
        F.least(F.lit(n_shards - 1), F.floor(twice_middle / F.lit(max(2 * target, 1.0))))
        .cast("int").alias("shard")))
    first = placed.groupBy(F.col("shard").alias("f_shard")).agg(F.min("at").alias("at0"))
    return (placed.join(F.broadcast(first), F.col("shard") == F.col("f_shard"))
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
                    F.lit("bytes").alias("law"), "shard", (F.col("at") - F.col("at0")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
