"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.base import WORD, running_start, stored, table, word_count

#: Fixed values of the mix: weights by source order, share of all words, passes at most.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
PASSES = 2
#: Words of a block.
BLOCK = 128
#: Golden-ratio step on a circle of 10^18 points.
CIRCLE = 10**18
STEP = 618033988749894848
#: Slots that one task ranks at a time.
RUN = 4096


def _d(x) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast("decimal(38,0)")


def source_targets(sized: DataFrame) -> DataFrame:
    """One row per source: source, source_size, weight, target.

    Sources run by code point, null last. Together they share 150 % of all words by weight;
    none gets above twice its size, and what it leaves goes to the others by weight: in
    the order of size / weight the sources that stop are the first ones.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    nulls_last = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(nulls_last)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), ((place - 1) % len(WEIGHTS) + 1).cast("int"))
    ranked = sums.withColumn("_place", place).withColumn("weight", weight)
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "_place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    cap = F.col("source_size") * float(PASSES)
    total = F.sum("source_size").over(everything) * SHARE
    level = (total - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    filled = ranked.withColumn("_cap", cap).withColumn("_level", level).withColumn("_rank", F.row_number().over(by_ratio))
    free = F.when(F.col("_cap") > F.col("weight") * F.col("_level"), F.struct("_rank", "_level"))
    found = F.min(free).over(everything)["_level"]
    target = F.least("_cap", F.coalesce(F.col("weight") * found, F.col("_cap")))
    return filled.withColumn("target", target).select("source", "source_size", "weight", "_place", "target")


def schedule(spark: SparkSession, targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix in order: slot, _place (of the source), pass, block, blocks.

    Slot i takes the golden-ratio point i * STEP mod CIRCLE through the cumulative targets to
    a source, so every stretch of slots holds the sources near their shares. Slots are
    ranked per source in runs of RUN slots; the r-th slot of a source takes its block
    r mod blocks in pass r div blocks. A rank past the last allowed pass is left out.
    ``targets`` has one row per source and is collected.
    """
    rows = [r for r in targets.orderBy("_place").collect() if r["target"] and r["target"] > 0]
    total = sum(r["target"] for r in rows)
    slots = round(total / block)
    if rows and not slots:
        slots = 1
    bounds, places, run = [], [], 0.0
    for r in rows:
        run += r["target"]
        bounds.append(min(CIRCLE, int(run / total * CIRCLE)))
        places.append((r["_place"], max(1, round(r["source_size"] / block))))
    if not rows:
        return spark.range(0).select(
            F.col("id").alias("slot"), F.lit(0).alias("_place"), F.col("id").alias("pass"), F.col("id").alias("block"), F.col("id").alias("blocks")
        )
    point = F.pmod(_d(F.col("slot")) * _d(STEP), _d(CIRCLE)).cast("long")
    # The last bound is the circle's end whatever the rounding.
    index = F.size(F.filter(F.array(*[F.lit(b) for b in bounds[:-1]] or [F.lit(CIRCLE)]), lambda b: b <= F.col("_point")))
    drawn = spark.range(slots).select(
        F.col("id").alias("slot"), point.alias("_point"), F.expr(f"id div {RUN}").alias("_run")
    ).select("slot", "_run", F.element_at(F.array(*[F.struct(F.lit(p).alias("p"), F.lit(n).cast("long").alias("n")) for p, n in places]), index + 1).alias("_s"))
    drawn = drawn.select("slot", "_run", F.col("_s.p").alias("_place"), F.col("_s.n").alias("blocks"))
    ranked = running_start(drawn, ["_place"], "_run", ["slot"], F.lit(1).cast("long"), "_r")
    return ranked.select(
        "slot", "_place", F.expr("_r div blocks").alias("pass"), F.expr("_r % blocks").alias("block"), "blocks"
    ).where(F.col("pass") < PASSES)


def pieces(docs: DataFrame, targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Shuffled documents laid out along their source's line of words and cut into blocks.

    Block b of n covers the words from b * size div n up to (b + 1) * size div n. One row per
    document and block it reaches into; a document without words has one row of length 0.
    """
    rows = docs.withColumn("_bucket", F.substring("_hash", 1, 3))
    laid = running_start(rows, ["source"], "_bucket", ["_hash", "doc_id", "size", "_row"], F.col("size"), "_from")
    s = targets.select(F.col("source").alias("_source"), "source_size", "target", "_place")
    joined = laid.join(s, laid["source"].eqNullSafe(s["_source"])).drop("_source")
    n = F.greatest(F.lit(1), F.round(F.col("source_size") / block)).cast("long")
    joined = joined.withColumn("_n", n)

    def of(word: Column) -> Column:
        return F.floor((((_d(word) + 1) * _d(F.col("_n"))) - 1) / _d(F.col("source_size"))).cast("long")

    def edge(b: Column) -> Column:
        return F.floor(_d(b) * _d(F.col("source_size")) / _d(F.col("_n"))).cast("long")

    first, last = of(F.col("_from")), of(F.col("_from") + F.col("size") - 1)
    reach = F.when(F.col("size") > 0, F.sequence(first, last)).otherwise(F.array(F.lit(-1).cast("long")))
    cut = joined.withColumn("block", F.explode(reach))
    span = F.least(F.col("_from") + F.col("size"), edge(F.col("block") + 1)) - F.greatest(F.col("_from"), edge(F.col("block")))
    return cut.withColumn("length", F.when(F.col("block") < 0, 0).otherwise(span).cast("long"))


def mix(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, start_passes.

    ``taken`` counts the words the mix takes from it, repeats included, at most twice its
    size; ``start_passes`` in how many passes the block holding its first word is taken.
    The order of documents in a source is that of MD5 hashes of their ids, so reruns agree.

    A null text has no words, is taken 0 times and keeps its row; a null source is a source
    of its own; a null id hashes as "". Repeated rows are documents of their own. Without
    words every target is 0. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    sized = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            word_count("text").alias("size"),
            F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_hash"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "sized",
    )
    targets = stored(source_targets(sized), "targets")
    times = schedule(spark, targets, block).groupBy(F.col("_place").alias("_p"), F.col("block").alias("_b")).agg(F.count(F.lit(1)).alias("times"))
    cut = pieces(sized, targets, block)
    counted = cut.join(times, (cut["_place"] == times["_p"]) & (cut["block"] == times["_b"]), "left")
    times_here = F.coalesce(F.col("times"), F.lit(0))
    first = F.min(F.struct("block", times_here.alias("t")))["t"]
    return counted.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("size").alias("size"),
        F.first("source_size").alias("source_size"),
        F.first("target").alias("target"),
        F.sum(F.col("length") * times_here).cast("long").alias("taken"),
        first.cast("long").alias("start_passes"),
    ).drop("_row")


def mixed_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``: each once per pass that takes
    the block of its first word. Documents without words are in no mix. Rows that repeat an
    id all follow the row that is taken most often.
    """
    passes = (
        mix(docs.select("doc_id", "source", "text"), block)
        .groupBy(F.col("doc_id").alias("_mix_id"))
        .agg(F.max("start_passes").alias("_mix_passes"))
        .where("_mix_passes > 0")
    )
    return (
        docs.where(word_count("text") > 0)
        .join(passes, docs["doc_id"].eqNullSafe(passes["_mix_id"]))
        .withColumn("_mix_pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_passes"))))
        .select(*[docs[c] for c in docs.columns])
    )


def op10_golden_ratio_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents", "doc_id", "source", "text")).drop("start_passes")


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), sums AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sized GROUP BY source
), weighed AS (
  SELECT *, [3.0, 1.0, 2.0][((place - 1) % 3 + 1)::INTEGER]::DOUBLE AS weight FROM sums
), levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5
      - coalesce(sum(2 * source_size) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level,
    row_number() OVER (ORDER BY source_size / weight, place) AS rank
  FROM weighed WINDOW before AS (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), water AS (
  SELECT arg_min(level, rank) FILTER (WHERE 2 * source_size > weight * level) AS level FROM levels
), targets AS (
  SELECT source, source_size, place, least(2 * source_size, coalesce(weight * water.level, 2 * source_size)) AS target,
    greatest(1, round(source_size / {BLOCK}))::BIGINT AS n
  FROM levels, water
), cum AS (
  SELECT *, sum(target) OVER (ORDER BY place) AS upto, sum(target) OVER () AS total FROM targets WHERE target > 0
), bounds AS (
  SELECT *, trunc(coalesce(lag(upto) OVER (ORDER BY place), 0) / total * 1000000000000000000)::BIGINT AS lo,
    CASE WHEN upto = max(upto) OVER () THEN 1000000000000000000 ELSE trunc(upto / total * 1000000000000000000)::BIGINT END AS hi
  FROM cum
), slots AS (
  SELECT i AS slot, ((i::HUGEINT * {STEP}) % 1000000000000000000)::BIGINT AS p
  FROM range((SELECT greatest(1, round(max(total) / {BLOCK}))::BIGINT FROM cum)) AS r(i)
), ranked AS (
  SELECT place, n, row_number() OVER (PARTITION BY place ORDER BY slot) - 1 AS r
  FROM slots JOIN bounds ON p >= lo AND p < hi
), times AS (
  SELECT place, r % n AS block, count(*) AS times FROM ranked WHERE r < {PASSES} * n GROUP BY ALL
), laid AS (
  SELECT s.*, coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY h, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, t.source_size, t.target, t.place, t.n
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), cut AS (
  SELECT *, unnest(CASE WHEN size > 0 THEN range(
      (((start + 1) * n - 1) // source_size::HUGEINT)::BIGINT,
      (((start + size) * n - 1) // source_size::HUGEINT)::BIGINT + 1) ELSE [-1] END) AS block FROM laid
)
SELECT doc_id, any_value(size) AS size, any_value(source_size)::BIGINT AS source_size, any_value(target) AS target,
  sum(CASE WHEN cut.block < 0 THEN 0 ELSE (least(start + size, ((cut.block + 1) * source_size::HUGEINT) // n)
    - greatest(start, (cut.block * source_size::HUGEINT) // n)) * coalesce(times, 0) END)::BIGINT AS taken
FROM cut LEFT JOIN times ON cut.place = times.place AND cut.block = times.block
GROUP BY doc_id
"""
