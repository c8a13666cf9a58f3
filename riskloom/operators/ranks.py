"""Global running totals and exact quantiles without a single-task sort.

A running total over a whole table is normally one unpartitioned window, hence one
task. Here the order column is cut into value ranges of about equal row counts; each
range is summed in its own task and shifted by the totals of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, replace
from fractions import Fraction

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialise

SAMPLE_SEED = 17


@dataclass(frozen=True)
class RankPlan:
    """How the work is cut; every plan gives the same results.

    ``rows_per_bucket``: rows of a value range, which is one task's work; below it a key's
    rows are one range. ``sample_per_cut``: rows looked at per cut point; they choose the ranges
    to work in, the results come from all rows. ``accuracy``: a sketch of all values tells a
    quantile's place to one in so many ranks. ``whole_rows``: up to so many values a column is searched whole.
    ``least_ranges``: ranges to cut into even if the rows are few, so that small tables can
    check the plan of large ones.
    """

    rows_per_bucket: int = 250_000
    sample_per_cut: int = 200
    accuracy: int = 10_000
    whole_rows: int = 50_000
    least_ranges: int = 1


_PLAN: ContextVar[RankPlan] = ContextVar("rank_plan", default=RankPlan())


@contextmanager
def rank_plan(**settings: int) -> Iterator[RankPlan]:
    """Use other plan settings while operators build their frames."""
    token = _PLAN.set(replace(_PLAN.get(), **settings))
    try:
        yield _PLAN.get()
    finally:
        _PLAN.reset(token)


def _free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` begins with it."""
    while any(c.lower().startswith(name) for c in df.columns):
        name += "_"
    return name


def _sample(df: DataFrame, rows: int, wanted: int) -> DataFrame:
    """About ``wanted`` of the ``rows``, so that one task can summarise them."""
    return df if rows <= wanted else df.sample(wanted / rows, SAMPLE_SEED)


def _double(value: float) -> str:
    return f"double('{value!r}')"


def _cut_points(df: DataFrame, order: str, rows_per_bucket: int, at_most: int | None = None) -> list[float]:
    """Increasing values that cut ``df`` into ranges of about ``rows_per_bucket`` rows.
    Only this list, one number per range, reaches the driver. Rows are not counted where
    ``at_most`` so many, one range, are known to be there."""
    least = _PLAN.get().least_ranges
    if at_most is not None and at_most <= rows_per_bucket and least < 2:
        return []
    rows = df.count()
    wanted = max(least, -(-rows // rows_per_bucket))
    if wanted < 2:
        return []
    grid = ", ".join(_double(i / wanted) for i in range(1, wanted))
    text = f"percentile_approx(cast({order} as double), array({grid}), {10 * wanted})"
    few = _sample(df, rows, wanted * _PLAN.get().sample_per_cut)
    return sorted(set(few.agg(F.expr(text).alias("cuts")).first()["cuts"] or ()))


def value_ranges(
    df: DataFrame, order: str, name: str, rows_per_bucket: int | None = None
) -> tuple[DataFrame, int]:
    """``df`` with the number (int, from 0) of the range that ``order`` lies in, and how many
    ranges there are. Cut points are literals, as in ``running_totals``."""
    cuts = _cut_points(df, order, rows_per_bucket or _PLAN.get().rows_per_bucket)
    if not cuts:
        return df.withColumn(name, F.lit(0)), 1
    number, place = _free_name(df, "_order"), _free_name(df, "_range")
    numeric = df.withColumn(number, F.col(order).cast("double"))
    edges = [float("-inf"), *cuts, float("inf")]
    ranged = Bucketizer(splits=edges, inputCol=number, outputCol=place).transform(numeric)
    return ranged.select(*df.columns, F.col(place).cast("int").alias(name)), len(edges) - 1


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    keys: Sequence[str] = (),
    *,
    descending: bool = False,
    rows_per_bucket: int | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Add ``before_<c>`` (sum over the rows ahead) and ``total_<c>`` (sum per key).

    ``order`` must be numeric and unique within a key, neither it nor the keys NULL, and
    ``df`` cheap to read again (see ``materialise``). The cut points are literals in the
    plan, so every re-run of a task puts a row into the same range. ``rows_per_bucket``
    defaults to the ``rank_plan`` in force; ``at_most`` is a known bound of the rows. Columns of
    ``df`` may have any names.
    """
    keys = list(keys)
    cuts = _cut_points(df, order, rows_per_bucket or _PLAN.get().rows_per_bucket, at_most)
    direction = F.desc(order) if descending else F.asc(order)
    zero = F.lit(0)
    if not cuts:
        # Checked above: everything fits into one range per key.
        ahead = Window.partitionBy(*keys).orderBy(direction)
        ahead = ahead.rowsBetween(Window.unboundedPreceding, -1)
        group = Window.partitionBy(*keys)
        return df.withColumns(
            {
                **{f"before_{c}": F.coalesce(F.sum(c).over(ahead), zero) for c in sums},
                **{f"total_{c}": F.sum(c).over(group) for c in sums},
            }
        )

    edges = [float("-inf"), *cuts, float("inf")]
    number, place = _free_name(df, "_order"), _free_name(df, "_range")
    inner, outer = _free_name(df, "_in"), _free_name(df, "_at")
    numeric = df.withColumn(number, F.col(order).cast("double"))
    ranged = Bucketizer(splits=edges, inputCol=number, outputCol=place).transform(numeric)
    ranged = ranged.withColumn(place, F.col(place).cast("int")).drop(number)

    # One row per range and key: a window over them is short.
    range_order = Window.partitionBy(*keys).orderBy(F.desc(place) if descending else place)
    range_order = range_order.rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*keys)
    offsets = (
        ranged.groupBy(*keys, place)
        .agg(*(F.sum(c).alias(f"_sum_{c}") for c in sums))
        .select(
            *keys,
            place,
            *(F.coalesce(F.sum(f"_sum_{c}").over(range_order), zero).alias(f"{outer}_{c}") for c in sums),
            *(F.sum(f"_sum_{c}").over(group).alias(f"total_{c}") for c in sums),
        )
    )
    ahead = Window.partitionBy(*keys, place).orderBy(direction)
    ahead = ahead.rowsBetween(Window.unboundedPreceding, -1)
    within = ranged.withColumns(
        {f"{inner}_{c}": F.coalesce(F.sum(c).over(ahead), zero) for c in sums}
    )
    return within.join(offsets, [*keys, place]).select(
        *(F.col(c) for c in df.columns),
        *((F.col(f"{outer}_{c}") + F.col(f"{inner}_{c}")).alias(f"before_{c}") for c in sums),
        *(F.col(f"total_{c}") for c in sums),
    )


@dataclass(frozen=True)
class Quantiles:
    """Number of values and the exact quantiles of one column (None when empty)."""

    count: int
    values: tuple[float | None, ...]


def _position(n: int, q: Fraction) -> tuple[int, float]:
    """0-based lower rank of quantile ``q`` among ``n`` values, and the step beyond it."""
    scaled = (n - 1) * q.numerator
    return scaled // q.denominator, (scaled % q.denominator) / q.denominator


def _disjoint(ranges: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Closed ranges with overlaps merged, in order."""
    merged: list[tuple[float, float]] = []
    for low, high in sorted(ranges):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], high))
        else:
            merged.append((low, high))
    return merged


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], quantiles: Sequence[Fraction | str | float]
) -> dict[str, Quantiles]:
    """Exact, linearly interpolated quantiles of each column; NULL and NaN are skipped.

    One pass counts the values and summarises them in a mergeable sketch, whose error bound
    narrows every wanted rank to a small value range. A second counts, per range, the values
    below and inside, and a third shuffles the values inside, as (value, count) pairs; the wanted
    ranks are picked from these. Four jobs, and three where columns are short enough to be
    searched whole. Should a range miss its rank, that column is done again with all
    its values. The driver sees counts per range and the values asked for, never the data.
    """
    fractions = [q if isinstance(q, Fraction) else Fraction(str(q)) for q in quantiles]
    # NaN becomes NULL once, here; aggregates then skip both.
    double = {c: f"cast({c} as double)" for c in columns}
    values = df.selectExpr(*(f"if(isnan({x}), null, {x}) AS {c}" for c, x in double.items()))
    accuracy = _PLAN.get().accuracy
    slack = 3.0 / accuracy
    around = [min(max(float(q) + d, 0.0), 1.0) for q in fractions for d in (-slack, slack)]
    grid = f"array({', '.join(map(_double, around))})"
    counts = [text for c in columns for text in (f"count({c}) AS count__{c}", f"percentile_approx({c}, {grid}, {accuracy}) AS near__{c}")]
    row = values.agg(*map(F.expr, counts)).first()
    sizes = {c: row[f"count__{c}"] for c in columns}
    ranks = {
        c: {r for q in fractions for r in _ranks_of(sizes[c], q)} for c in columns if sizes[c]
    }
    if not ranks:
        return {c: Quantiles(0, (None,) * len(fractions)) for c in columns}

    whole = [(float("-inf"), float("inf"))]
    long = [c for c in ranks if sizes[c] > _PLAN.get().whole_rows]
    ranges = dict.fromkeys(ranks, whole)
    if long:
        ranges.update(_likely_ranges({c: row[f"near__{c}"] for c in long}, around))
    found = _values_at(values, ranks, ranges, sizes)
    missed = {c: r for c, r in ranks.items() if any((c, k) not in found for k in r)}
    if missed:
        found.update(_values_at(values, missed, dict.fromkeys(missed, whole), sizes))

    result = {}
    for c in columns:
        out: list[float | None] = []
        for q in fractions:
            if not sizes[c]:
                out.append(None)
                continue
            rank, step = _position(sizes[c], q)
            low = found[c, rank]
            out.append(low if step == 0 else low + (found[c, rank + 1] - low) * step)
        result[c] = Quantiles(sizes[c], tuple(out))
    return result


def _ranks_of(n: int, q: Fraction) -> tuple[int, ...]:
    if n == 0:
        return ()
    rank, step = _position(n, q)
    return (rank,) if step == 0 else (rank, rank + 1)


def _likely_ranges(
    near: dict[str, list[float]], around: Sequence[float]
) -> dict[str, list[tuple[float, float]]]:
    """Value ranges around every quantile, as wide as the sketch may err."""
    return {
        c: _disjoint(
            [
                (
                    float("-inf") if around[k] <= 0 else found[k],
                    float("inf") if around[k + 1] >= 1 else found[k + 1],
                )
                for k in range(0, len(around), 2)
            ]
        )
        for c, found in near.items()
    }


def _values_at(
    values: DataFrame,
    ranks: dict[str, set[int]],
    ranges: dict[str, list[tuple[float, float]]],
    sizes: dict[str, int],
) -> dict[tuple[str, int], float]:
    """Values at the wanted ranks, as far as they lie inside the given ranges. ``sizes``: values
    of each column."""
    spark = values.sparkSession
    places = {
        (c, k): f"({c} >= {_double(low)} AND {c} <= {_double(high)})"
        for c in ranks
        for k, (low, high) in enumerate(ranges[c])
    }
    starts, inside = _rows_around(values, {c: ranges[c] for c in ranks}, sizes)
    # Rows without any value in a range are dropped before anything is unpivoted.
    cells = ", ".join(
        f"named_struct('feature', '{c}', 'place', CASE "
        + " ".join(f"WHEN {places[c, k]} THEN {k}" for k in range(len(ranges[c])))
        + f" END, 'value', {c})"
        for c in ranks
    )
    counted = materialise(
        values.filter(" OR ".join(places.values()))
        .selectExpr(f"inline(array({cells}))")
        .filter("place IS NOT NULL")
        .groupBy("feature", "place", "value")
        .agg(F.count("*").alias("n"))
    )
    targets = [
        (c, place, k, k - starts[c, place])
        for c, place in inside
        for k in ranks[c]
        if 0 <= k - starts[c, place] < inside[c, place]
    ]
    if not targets:
        return {}
    ranked = running_totals(counted, "value", ["n"], ["feature", "place"], at_most=sum(inside.values()))
    wanted = spark.createDataFrame(targets, "feature string, place int, rank long, inner long")
    hits = (
        ranked.join(F.broadcast(wanted), ["feature", "place"])
        .filter("inner >= before_n AND inner < before_n + n")
        .select("feature", "rank", "value")
        .collect()
    )
    return {(r["feature"], r["rank"]): r["value"] for r in hits}


def _rows_around(
    values: DataFrame, ranges: dict[str, list[tuple[float, float]]], sizes: dict[str, int]
) -> tuple[dict[tuple[str, int], int], dict[tuple[str, int], int]]:
    """Rows below each range and inside it, counted in one scan without a shuffle of rows.

    What follows from the sizes alone is not counted."""
    texts = {}
    for c, found in ranges.items():
        for k, (low, high) in enumerate(found):
            if low > float("-inf"):
                texts[c, k, "below"] = f"count_if({c} < {_double(low)})"
            if high < float("inf"):
                texts[c, k, "upto"] = f"count_if({c} <= {_double(high)})"
    row = values.agg(*(F.expr(t) for t in texts.values())).first() if texts else ()
    told = dict(zip(texts, row))
    below = {(c, k): told.get((c, k, "below"), 0) for c in ranges for k in range(len(ranges[c]))}
    inside = {(c, k): told.get((c, k, "upto"), sizes[c]) - start for (c, k), start in below.items()}
    return below, inside
