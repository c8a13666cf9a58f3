"""Rendezvous hashing of record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.base import running_start, stored, table, text_crc

SHARDS = 24
#: Hexadecimal digits of the hash a score is made of (52 bits: exact in a double).
DIGITS = 13


def rendezvous(key: Column, shards: int, weights: Sequence[float] | None = None) -> Column:
    """The shard that scores highest for ``key``: -weight / ln(u), u in (0, 1) by key and shard.

    A shard's score never depends on the other shards. Adding one therefore moves only the
    rows that the new shard wins, and changing a weight only rows of that shard or into it.
    Equal scores go to the smaller shard. A null key is the key "" and has a shard too.
    """
    weights = list(weights or [1.0] * shards)
    if shards < 1 or len(weights) != shards or min(weights) <= 0:
        raise ValueError("need a positive weight for each of one or more shards")
    text = F.coalesce(key.cast("string"), F.lit(""))
    scored = []
    for j, w in enumerate(weights):
        digits = F.substring(F.md5(F.concat(text, F.lit(f"#{j}"))), 1, DIGITS)
        u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**DIGITS)
        scored.append(F.struct((F.lit(-float(w)) / F.log(u)).alias("s"), F.lit(-j).alias("j")))
    return -(F.array_max(F.array(*scored))["j"])


def assign_shards(
    docs: DataFrame, shards: int = SHARDS, weights: Sequence[float] | None = None, grown_weight: float = 1.0
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 bytes of the text plus 8. ``slot`` counts the rows of a shard from
    0 without gaps, by a hash of id and text, then id; 4096 buckets of that hash are numbered
    each in its own task. ``grown_shard`` is the shard once there is one more.

    A null text has size 8 and the checksum of an empty one; a null id is the key "".
    Repeated rows share shard and size and get slots of their own. An empty table gives an
    empty result; other columns of ``docs`` are not looked at.
    """
    weights = list(weights or [1.0] * shards)
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        text_crc("text").alias("text_crc32"),
        rendezvous(F.col("doc_id"), shards, weights).cast("int").alias("shard"),
        rendezvous(F.col("doc_id"), shards + 1, [*weights, grown_weight]).cast("int").alias("grown_shard"),
    )
    mixed = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("text_crc32").cast("string")))
    rows = stored(narrow.withColumn("_bucket", F.substring(mixed, 1, 3)), "shards")
    order = ["doc_id", "text_crc32", "size"]
    return running_start(rows, ["shard"], "_bucket", order, F.lit(1), "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), "grown_shard",
    )


def op8_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents", "doc_id", "text"))


def _best(shards: int) -> str:
    u = f"(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '#' || j), 1, {DIGITS}))::BIGINT + 0.5) / {float(16**DIGITS)}"
    return (
        f"list_max(list_transform(range({shards}), lambda j: "
        f"{{'s': -1.0 / ln({u}), 'j': -j}})).j"
    )


ORACLE = f"""
WITH crc_table AS (
  SELECT list(list_reduce(list_concat([i], range(8)),
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)
), sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size,
    hex(encode(coalesce(text, ''))) AS h FROM documents
), summed AS (
  SELECT doc_id, size, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT],
      list_transform(range(size - 8), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS text_crc32
  FROM sized, crc_table
), placed AS (
  SELECT *, (-{_best(SHARDS)})::INTEGER AS shard, (-{_best(SHARDS + 1)})::INTEGER AS grown_shard,
    substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || text_crc32), 1, 3) AS bucket
  FROM summed
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id, text_crc32, size) - 1 AS slot, grown_shard
FROM placed
"""
