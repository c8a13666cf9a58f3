"""Benchmark decontamination by typed templates, in DataFrame functions only.

Numbers, names and units become typed placeholders, windows of template words are
hash-joined, and the values behind the placeholders must map one to one. A copied question
is found, and so is one whose numbers or names were changed throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.base import stored, table

#: Template words of a window. Shorter items are one window of their own length.
WINDOW = 6
#: Items with fewer words than this are never searched for.
LEAST = 3
#: Share of an item's words that matched windows must cover.
COVER = 0.5
#: Placeholders: private characters that no text has in this use.
NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"
#: Behind a value that still stands behind its placeholder.
CLOSE = "\ue003"
#: Units that count as such right behind a number.
UNITS = (
    "mm cm dm m km in ft yd mi mile miles metre metres meter meters inch inches foot feet "
    "mg g kg t lb lbs oz gram grams kilogram kilograms ton tons tonne tonnes pound pounds "
    "ml cl l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hr hour hours "
    "day days week weeks month months year years ms km/h kmh mph kph hz khz mhz ghz w kw mw kwh v a "
    "eur usd gbp euro euros dollar dollars cent cents percent % € $ £ °c °f degree degrees k "
    "heure heures jour jours stunde stunden tag tage hora horas día días"
).split()


def _tagged(text: Column) -> Column:
    """Lower-case text without punctuation; each value stands behind its placeholder, up to CLOSE.

    Values hold no blanks, so a value is in the word that its placeholder is in.
    """
    t = F.coalesce(text, F.lit("")).cast("string")
    t = F.regexp_replace(t, f"[{NUMBER}{NAME}{UNIT}{CLOSE}]", " ")
    t = F.regexp_replace(t, r"(?<![\p{L}\p{N}])[-+]?\p{N}+(?:[.,:/]\p{N}+)*", f"{NUMBER}$0{CLOSE}")
    # A title-case word inside a sentence.
    t = F.regexp_replace(t, rf"(?<=[\p{{L}}{CLOSE},;] )\p{{Lu}}\p{{Ll}}+(?:['’-]\p{{L}}+)*", f"{NAME}$0{CLOSE}")
    units = "|".join(sorted((u.replace("$", r"\$") for u in UNITS), key=len, reverse=True))
    t = F.regexp_replace(F.lower(t), rf"({NUMBER}[^{CLOSE}]*{CLOSE})[ ]?({units})(?![\p{{L}}\p{{N}}])", f"$1 {UNIT}$2{CLOSE}")
    # Tags stay as they are, punctuation outside them goes.
    return F.regexp_replace(t, rf"([{NUMBER}{NAME}{UNIT}][^{CLOSE}]*{CLOSE})|[^\p{{L}}\p{{N}}\s{NUMBER}{NAME}{UNIT}]+", "$1")


def _bare(tagged: Column) -> Column:
    return F.regexp_replace(tagged, rf"([{NUMBER}{NAME}{UNIT}])[^{CLOSE}]*{CLOSE}", "$1")


def template(text: Column) -> Column:
    """Lower-case text without punctuation, with placeholders."""
    return _bare(_tagged(text))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def template_words(text: Column) -> Column:
    return _words(template(text))


def windows(rows: DataFrame, keys: list[str], text: str, lengths: list[int]) -> DataFrame:
    """One row per window of each length: keys, words, hash, pos, slots.

    ``slots`` holds the values behind the window's placeholders, those glued to letters or to
    each other too, or null if the text has none.
    """
    words = F.col("_words")
    base = rows.select(*keys, _tagged(F.col(text)).alias("_tagged"))
    # Only texts with a placeholder are searched for the values behind them.
    some, nothing = F.contains("_tagged", F.lit(CLOSE)), F.array().cast("array<string>")

    def values(w: Column) -> Column:
        found = F.regexp_extract_all(w, F.lit(f"[{NUMBER}{NAME}{UNIT}]([^{CLOSE}]*){CLOSE}"), F.lit(1))
        return F.when(F.contains(w, F.lit(CLOSE)), found).otherwise(nothing)

    # _values[k]: the values in the k-th word; bare and tagged text split at the same blanks.
    base = base.select(
        *keys, _words(F.when(some, _bare(F.col("_tagged"))).otherwise(F.col("_tagged"))).alias("_words"),
        F.when(some, F.transform(_words(F.col("_tagged")), values)).alias("_values"),
    )
    base = base.select(*keys, "_words", "_values", F.size("_words").alias("words"))

    def cut(length: int) -> Column:
        def one(p: Column) -> Column:
            here = F.when(F.col("_values").isNotNull(), F.flatten(F.slice("_values", p + 1, length)))
            return F.struct(F.xxhash64(F.slice(words, p + 1, length)).alias("hash"), p.alias("pos"), F.lit(length).alias("length"), here.alias("slots"))

        return F.when(F.size(words) >= length, F.transform(F.sequence(F.lit(0), F.size(words) - length), one))

    all_cuts = [F.coalesce(cut(n), F.array().cast("array<struct<hash:bigint,pos:int,length:int,slots:array<string>>>")) for n in lengths]
    found = all_cuts[0] if len(all_cuts) == 1 else F.concat(*all_cuts)
    return base.select(*keys, "words", F.explode(found).alias("_w")).select(
        *keys, "words", F.col("_w.hash").alias("hash"), F.col("_w.pos").alias("pos"),
        F.col("_w.length").alias("length"), F.col("_w.slots").alias("slots"),
    )


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Windows of the distinct items: item_id, words, hash, pos, length, slots.

    Items with equal texts count as their smallest id."""
    items = (
        benchmark.where("text IS NOT NULL AND item_id IS NOT NULL")
        .groupBy("text")
        .agg(F.min(F.col("item_id").cast("long")).alias("item_id"))
        .withColumn("_n", F.size(template_words(F.col("text"))))
        .where(F.col("_n") >= LEAST)
    )
    items = stored(items, "items")
    # At most window - 3 short lengths.
    short = [r["_n"] for r in items.where(F.col("_n") < window).select("_n").distinct().collect()]
    cuts = windows(items, ["item_id"], "text", [window, *sorted(short)])
    return stored(cuts.where((F.col("length") == window) | (F.col("words") == F.col("length"))), "item-windows")


#: What tells documents apart: equal ids with equal texts are judged alike.
KEY = ["doc_id", "_code", "_hash"]


def _key(doc_id: Column, text: Column) -> list[Column]:
    return [doc_id.cast("long").alias("doc_id"), F.hash(text).alias("_code"), F.xxhash64(text).alias("_hash")]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*_key(F.col("doc_id"), F.col("text")), "text")


def _same(rows: DataFrame, found: DataFrame) -> tuple[DataFrame, Column]:
    """``found`` under other names, and the condition that its document is that of ``rows``."""
    found = found.withColumnsRenamed({k: f"_found{k}" for k in KEY})
    return found, (rows["_hash"] == found["_found_hash"]) & (rows["_code"] == found["_found_code"]) & rows["doc_id"].eqNullSafe(found["_founddoc_id"])


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, cover: float = COVER) -> DataFrame:
    """One row per document and item found in it: doc_id, _code, _hash, item_id, cover, reparameterised.

    A document is an id and a text (by two hashes of it), so rows that share an id, null ids
    too, are judged each by its own text.

    Windows meet by hash; Spark broadcasts the benchmark's if their size allows and
    shuffles both sides if not. At one shift between text and item, each slot value of the
    item must stand for one value in the text and the other way round; of shifts that break
    this only windows without any slot count. ``cover`` is the share of the item's words that lie in a window found.
    """
    none = F.array().cast("array<string>")
    marks = benchmark_windows(benchmark, window).select(
        "item_id", F.col("words").alias("item_words"), F.col("hash").alias("item_hash"), F.col("pos").alias("item_pos"),
        "length", F.col("slots").alias("item_slots"),
    )
    lengths = [r["length"] for r in marks.select("length").distinct().collect()] or [window]
    ours = windows(_keyed(docs).select(*KEY, "text"), KEY, "text", sorted(lengths))
    # Equal templates have equally many values; a window that does not met by chance.
    met = ours.join(marks, (ours["hash"] == marks["item_hash"]) & (ours["length"] == marks["length"])).select(
        *KEY, "item_id", "item_words", "item_pos", marks["length"], (F.col("pos") - F.col("item_pos")).alias("shift"),
        F.coalesce("slots", none).alias("slots"), F.coalesce("item_slots", none).alias("item_slots"),
    ).where(F.size("slots") == F.size("item_slots"))
    pairs = F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d"))
    # An item's windows at one shift are few: the sets are bounded by the item's length.
    shifts = met.groupBy(*KEY, "item_id", "shift").agg(
        F.first("item_words").alias("item_words"),
        F.collect_set(F.struct("item_pos", "length", (F.size("slots") == 0).alias("plain"))).alias("at"),
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"),
    )
    one_to_one = (F.size(F.array_distinct(F.col("pairs.i"))) == F.size("pairs")) & (
        F.size(F.array_distinct(F.col("pairs.d"))) == F.size("pairs")
    )
    changed = F.col("fits") & F.exists("pairs", lambda p: ~p["i"].eqNullSafe(p["d"]))
    # Windows without a slot are the item's own words, whatever the values elsewhere.
    shifts = shifts.withColumn("fits", one_to_one).withColumn("at", F.filter("at", lambda a: F.col("fits") | a["plain"]))
    covered = F.flatten(F.transform("at", lambda a: F.sequence(a["item_pos"], a["item_pos"] + a["length"] - 1)))
    good = shifts.select(
        *KEY, "item_id", "item_words", F.array_distinct(covered).alias("covered"), changed.alias("changed")
    )
    # Distinct words of the item over all shifts: a passage with words put in still counts.
    per_word = good.select(*KEY, "item_id", "item_words", "changed", F.explode("covered").alias("word"))
    return (
        per_word.groupBy(*KEY, "item_id", "item_words", "word").agg(F.min("changed").alias("changed"))
        .groupBy(*KEY, "item_id", "item_words")
        .agg(F.count(F.lit(1)).alias("_n"), F.max("changed").alias("reparameterised"))
        .withColumn("cover", F.col("_n") / F.col("item_words"))
        .where(F.col("cover") >= cover)
        .select(*KEY, "item_id", "cover", "reparameterised")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, cover: float = COVER) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, first_item, best_cover, reparameterised.

    A null or empty text holds no item. Rows that share an id, null ids too, are judged each
    by its own text. An empty benchmark leaves all documents clean; an empty table of documents gives
    an empty result. Other columns are not looked at.
    """
    found = (
        contaminated(docs, benchmark, window, cover)
        .groupBy(*KEY)
        .agg(
            F.count(F.lit(1)).alias("_items"),
            F.min("item_id").alias("first_item"),
            F.max("cover").alias("best_cover"),
            F.max("reparameterised").alias("_changed"),
        )
    )
    rows = _keyed(docs).select(*KEY)
    return rows.join(*_same(rows, found), "left").select(
        "doc_id",
        F.col("_items").isNotNull().alias("contaminated"),
        F.coalesce("_items", F.lit(0)).alias("n_items"),
        "first_item",
        "best_cover",
        F.coalesce("_changed", F.lit(False)).alias("reparameterised"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, all columns kept; each row by its own text."""
    bad = contaminated(docs, benchmark).select(*KEY).distinct()
    names = [f"_{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names).select("*", *_key(F.col(names[docs.columns.index("doc_id")]), F.col(names[docs.columns.index("text")])))
    return rows.join(*_same(rows, bad), "left_anti").select(*names).toDF(*docs.columns)


def op5_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(
        table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    )
