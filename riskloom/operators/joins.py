"""Join of a large, possibly skewed table to one with unique keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialise

# A key is hot when it holds more rows than a task should take. However large the table,
# a hot key also holds more than one row in MOST_HOT; so there are fewer hot keys than
# that, and the broadcast of their partner rows has a bound.
ROWS_PER_TASK = 1_000_000
MOST_HOT = 65_536
# Other keys with more rows than a task should take are salted, and only their names and
# numbers of pieces are broadcast. They hold more than one row in MOST_SALTED.
MOST_SALTED = 1_048_576


def hot_keys(
    df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK, most: int = MOST_HOT
) -> DataFrame | None:
    """Keys that hold more than ``rows_per_task`` rows and more than 1/most of all rows.

    A stored table of fewer than ``most`` rows, or None if there are none. Nulls meet
    nothing and are never hot.
    """
    return large_keys(df, key, rows_per_task, most, most)[0]


def large_keys(
    df: DataFrame, key: str, rows_per_task: int, most: int, most_salted: int
) -> tuple[DataFrame | None, DataFrame | None]:
    """The hot keys, and the keys to salt with their number of ``pieces``; None for none.

    The table is counted once, and its total is asked for only where a key passes the
    first bound. A piece has at most ``rows_per_task`` rows or 1/most_salted of all rows,
    whichever is more, as far as the rows of a key differ.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    large = materialise(counts.filter(F.col("n") > rows_per_task))
    if large.isEmpty():
        return None, None
    total = df.count()
    hot = large.filter(F.col("n") * most > total).select(key)
    piece = max(rows_per_task, -(-total // most_salted))
    salted = large.filter((F.col("n") * most <= total) & (F.col("n") > piece))
    salted = salted.select(key, F.ceil(F.col("n") / piece).cast("int").alias("pieces"))
    return tuple(None if k.isEmpty() else k for k in (hot, salted))


def _salted_join(big: DataFrame, unique: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """Join the rows of ``keys`` alone: the rows of a key are dealt over its pieces by a hash of
    the row, and every piece meets its own copy of the partner row."""
    named = F.broadcast(keys.withColumnsRenamed({"pieces": "_pieces"}))
    row = F.xxhash64(*big.columns)
    dealt = big.join(named, key).withColumn("_salt", F.pmod(row, F.col("_pieces")).cast("int"))
    copies = unique.join(named, key).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
    return dealt.drop("_pieces").join(copies.drop("_pieces"), [key, "_salt"], how).drop("_salt")


def join_hot_split(
    big: DataFrame,
    unique: DataFrame,
    key: str,
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    most: int = MOST_HOT,
    most_salted: int = MOST_SALTED,
) -> DataFrame:
    """Join ``big`` to ``unique`` (one row per key) without gathering a key in one task.

    Rows of hot keys stay where they are and meet their few partner rows by broadcast; keys
    below that which still outgrow a task are salted; the rest is an ordinary join.
    ``how``: inner, left, left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    hot, salted = large_keys(big, key, rows_per_task, most, most_salted)
    rest, parts = big, []
    if hot is not None:
        # Fewer than ``most`` keys, and one partner row for each.
        named = F.broadcast(hot)
        few = F.broadcast(unique.join(named, key, "left_semi"))
        parts.append(rest.join(named, key, "left_semi").join(few, key, how))
        rest = rest.join(named, key, "left_anti")
    if salted is not None:
        parts.append(_salted_join(rest, unique, salted, key, how))
        rest = rest.join(F.broadcast(salted.select(key)), key, "left_anti")
    out = rest.join(unique, key, how)
    for part in parts:
        out = out.unionByName(part)
    return out
