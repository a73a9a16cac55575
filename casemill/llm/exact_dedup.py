"""Exact dedup by two-pass Bloom filtering, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.llm.shared import SPACES, grouped, materialize

#: Bits in one block of the filter: what Spark's bitmap functions hold in one value (4,096 bytes).
BLOCK = 32_768
#: The filter has this many bits for each row, and each hash sets two of them.
BITS_PER_ROW = 16
#: So many blocks of the filter (64 MB) are broadcast at one time; rows meet a larger filter slice by slice, and still aren't shuffled.
BROADCAST_BLOCKS = 16_384


def text_digest(text: Column) -> Column:
    """Hex SHA-256 of the text without the characters of [\\x20\\x09-\\x0D]; null counts as empty."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), SPACES, ""), 256)


def _bit(bitmap: Column, position: Column) -> Column:
    """Whether the bit at a position from 0 is set in a value of bitmap_construct_agg."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups rows whose texts are equal without white space.

    Returns a row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256. The row with the
    most code points in its original text stays, then the one with the smallest id; a null id comes last.

    Pass 1 adds each digest to a blocked Bloom filter that counts: a digest sets two bits of one block, and
    a bit that was hit once only can belong to one row only. The bits hit twice or more are kept as bitmaps.
    Pass 2 tests each digest: if one of its bits isn't there, no other row has it, and the row passes
    straight through, never shuffled. The others are grouped by the full digest, which sorts out false
    positives; a digest that many rows share is split over all tasks. Digests, lengths and ids are written to shared storage once; texts are never shuffled.

    A filter of more than BROADCAST_BLOCKS blocks is met in as many passes over the digests as it has slices of that size: each
    pass reads the rows whose blocks are in its slice, which tasks have written in the order of their blocks.

    Very long texts are digested whole. Null and empty texts are equal. Repeated rows with one id form a group, and all of them that equal
    the kept id are marked kept. An empty table gives an empty result. Other columns are not read.
    """
    blocks = max(1, -(-docs.count() * BITS_PER_ROW // BLOCK))  # a table of Parquet files is counted by their footers
    number = lambda at, n: F.conv(F.substring("text_sha256", at, n), 16, 10).cast("long")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("n_points"), text_digest(F.col(text_col)).alias("text_sha256"))
    slim = slim.withColumns({"block": number(1, 12) % blocks, "bit_a": number(13, 4) % BLOCK, "bit_b": number(17, 4) % BLOCK})
    hashed = materialize(slim if blocks <= BROADCAST_BLOCKS else slim.sortWithinPartitions("block"), "digests")

    hit = hashed.select("block", F.explode(F.array("bit_a", "bit_b")).alias("bit")).groupBy("block", "bit").agg(F.count(F.lit(1)).alias("n"))
    repeated = hit.filter("n > 1").groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap")).withColumnRenamed("block", "filter_block")
    if blocks > BROADCAST_BLOCKS:
        repeated = materialize(repeated, "filter")
    tested = None
    for low in range(0, blocks, BROADCAST_BLOCKS):
        mine = lambda rows, block: rows if blocks <= BROADCAST_BLOCKS else rows.filter((F.col(block) >= low) & (F.col(block) < low + BROADCAST_BLOCKS))  # noqa: B023, E731
        met = mine(hashed, "block").join(F.broadcast(mine(repeated, "filter_block")), F.col("block") == F.col("filter_block"), "left")
        tested = met if tested is None else tested.unionByName(met)
    tested = tested.withColumn("maybe", F.coalesce(_bit(F.col("bitmap"), F.col("bit_a")) & _bit(F.col("bitmap"), F.col("bit_b")), F.lit(False)))
    # A digest whose two bits coincide hits that bit twice by itself: it is merely tested in vain.
    maybe = tested.filter("maybe").select("doc_id", "n_points", "text_sha256")
    best = F.struct((-F.col("n_points")).alias("order_1"), F.col("doc_id").isNull().alias("order_2"), F.col("doc_id").alias("id"))
    found = grouped(maybe, ["text_sha256"], F.col("doc_id"), {"best": F.min(best), "n": F.count(F.lit(1))}, {"keep_id": F.min("best")["id"], "group_size": F.sum("n")})
    several = found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    alone = tested.filter("NOT maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    return alone.unionByName(several)


def op6_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
k AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM k
"""
