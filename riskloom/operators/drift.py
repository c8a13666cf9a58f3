"""Population stability index of current traffic against a fitted baseline.

The baseline is fitted once into a small ``Profile`` (bin edges, shares, mean and count
per feature). Measuring traffic is then one scan that only counts: no unpivot, no join,
and one row of partial counts per task, in a batch or on a stream alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.config import Monitoring
from riskloom.operators.ranks import exact_quantiles

# Fixed value: floor of a bin's share, so that an empty bin stays finite.
EPSILON = 1e-6


@dataclass(frozen=True)
class FeatureProfile:
    """Baseline of one feature. ``edges`` are the inner bin bounds; None when the
    baseline is empty, () when it is constant."""

    name: str
    edges: tuple[float, ...] | None
    constant: bool
    counts: tuple[int, ...]
    valid: int
    mean: float | None
    rows: int


Profile = tuple[FeatureProfile, ...]


def shared_features(
    baseline: DataFrame, current: DataFrame, tracked: Sequence[str]
) -> tuple[list[str], list[str]]:
    """Tracked features present on both sides, and those that are not."""
    both = set(baseline.columns) & set(current.columns)
    return [f for f in tracked if f in both], [f for f in tracked if f not in both]


def _plain(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The features as doubles with NaN as NULL."""
    double = {f: f"cast({f} as double)" for f in features}
    return df.withColumns({f: F.expr(f"if(isnan({x}), null, {x})") for f, x in double.items()})


def bin_count_aggregates(edges: dict[str, Sequence[float] | None]) -> list[Column]:
    """Row count, and per feature the valid values, their mean and how many reach each
    inner edge. A bin's count is the difference of two neighbours, so every row is
    compared once per edge."""
    out = ["count(*) AS rows"]
    for name, inner in edges.items():
        out += [f"count({name}) AS valid__{name}", f"avg({name}) AS mean__{name}"]
        out += [
            f"count_if({name} >= double('{edge!r}')) AS reach__{name}__{b}"
            for b, edge in enumerate(inner or ())
        ]
    return [F.expr(text) for text in out]


def _bin_counts(reach: Sequence[int]) -> list[int]:
    """Counts per half-open bin from the numbers that reach its lower bound."""
    return [a - b for a, b in zip(reach, [*reach[1:], 0])]


def fit_profile(baseline: DataFrame, features: Sequence[str], bins: int = 10) -> Profile:
    """Exact quantile edges and bin counts of the baseline.

    Reads the baseline a few times: hand in a stored table or a materialised frame.
    """
    found = exact_quantiles(baseline, features, [Fraction(i, bins) for i in range(bins + 1)])
    inner: dict[str, tuple[float, ...] | None] = {}
    constant = {}
    for name in features:
        distinct = sorted({v for v in found[name].values if v is not None})
        constant[name] = len(distinct) == 1
        inner[name] = tuple(distinct[1:-1]) if distinct else None
    row = _plain(baseline, features).agg(*bin_count_aggregates(inner)).first()
    out = []
    for name in features:
        # Without an inner edge there is one open bin at most, and PSI is 0.
        reach = [row[f"reach__{name}__{b}"] for b in range(len(inner[name] or ()))]
        counts = _bin_counts([row[f"valid__{name}"], *reach]) if reach else []
        out.append(
            FeatureProfile(
                name=name,
                edges=inner[name],
                constant=constant[name],
                counts=tuple(counts),
                valid=row[f"valid__{name}"],
                mean=row[f"mean__{name}"],
                rows=row["rows"],
            )
        )
    return tuple(out)


def count_traffic(profile: Profile, current: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Bin counts of the current rows, one row per group. Also runs on a stream."""
    plain = _plain(current, [f.name for f in profile])
    return plain.groupBy(*by).agg(*bin_count_aggregates({f.name: f.edges for f in profile}))


def classify(psi: Column, monitoring: Monitoring | None = None) -> Column:
    """Status of a PSI; NULL or NaN is unknown."""
    m = monitoring or Monitoring()
    return (
        F.when(psi.isNull() | F.isnan(psi), "unknown")
        .when(psi >= m.psi_alert, "alert")
        .when(psi >= m.psi_warn, "warn")
        .otherwise("stable")
    )


PROFILE_ROW = (
    "feature string, known boolean, constant_baseline boolean, baseline_mean double, "
    "baseline_n bigint, lower array<double>, upper array<double>, expected array<double>"
)


def profile_frame(spark: SparkSession, profile: Profile) -> DataFrame:
    """The baseline as a table, one row per feature."""
    rows = []
    for f in profile:
        n, inner = len(f.counts), list(f.edges or ())
        shares = [max(c / f.valid, EPSILON) for c in f.counts]
        bounds = [None, *inner][:n], [*inner, None][:n]
        rows.append((f.name, f.edges is not None, f.constant, f.mean, f.rows, *bounds, shares))
    return spark.createDataFrame(rows, PROFILE_ROW)


def _by_feature(profile: Profile, traffic: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per feature and group, its bins as arrays of ten or so values."""
    structs = []
    for f in profile:
        reach = [f"valid__{f.name}", *(f"reach__{f.name}__{b}" for b in range(len(f.edges or ())))]
        bins = [f"{a} - {b}" for a, b in zip(reach, [*reach[1:], "0"])][: len(f.counts)]
        structs.append(
            f"named_struct('feature', '{f.name}', 'valid', valid__{f.name}, "
            f"'current_mean', mean__{f.name}, "
            f"'counts', cast(array({', '.join(bins)}) as array<bigint>))"
        )
    per_feature = traffic.selectExpr(
        *by, "rows AS current_n", f"inline(array({', '.join(structs)}))"
    )
    # One row per tracked feature: small enough to broadcast whatever the traffic.
    baseline = F.broadcast(profile_frame(traffic.sparkSession, profile))
    return per_feature.join(baseline, "feature")


def _actual(count: Column, valid: Column) -> Column:
    return F.greatest(F.try_divide(count.cast("double"), valid), F.lit(EPSILON))


def _term(expected: Column, actual: Column) -> Column:
    return (actual - expected) * F.ln(actual / expected)


def drift_rows(
    profile: Profile,
    traffic: DataFrame,
    by: Sequence[str] = (),
    monitoring: Monitoring | None = None,
) -> DataFrame:
    """One row per feature (and group) from the bin counts of ``count_traffic``."""
    valid = F.col("valid")
    terms = F.zip_with("expected", "counts", lambda e, c: _term(e, _actual(c, valid)))
    psi = F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)
    return (
        _by_feature(profile, traffic, by)
        .withColumn("psi", F.when(F.col("known") & (valid > 0), psi))
        .select(
            *by,
            "feature",
            "psi",
            classify(F.col("psi"), monitoring).alias("status"),
            "baseline_mean",
            "current_mean",
            "baseline_n",
            "current_n",
            "constant_baseline",
        )
    )


def drift_table(
    profile: Profile,
    current: DataFrame,
    by: Sequence[str] = (),
    monitoring: Monitoring | None = None,
) -> DataFrame:
    """PSI, status, means and counts of every profiled feature."""
    return drift_rows(profile, count_traffic(profile, current, by), by, monitoring)


def psi_breakdown(profile: Profile, current: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Where the mass moved: one row per feature and bin. Outer bounds are NULL."""
    zipped = F.arrays_zip("lower", "upper", "expected", "counts")
    actual = _actual(F.col("cell.counts"), F.col("valid"))
    return (
        _by_feature(profile, count_traffic(profile, current, by), by)
        .filter("valid > 0")
        .select(*by, "feature", "valid", F.posexplode(zipped).alias("bin", "cell"))
        .select(
            *by,
            "feature",
            "bin",
            F.col("cell.lower").alias("bin_lower"),
            F.col("cell.upper").alias("bin_upper"),
            F.col("cell.expected").alias("expected_pct"),
            actual.alias("actual_pct"),
            _term(F.col("cell.expected"), actual).alias("psi_contribution"),
        )
    )


def drift_alerts(drift: DataFrame) -> DataFrame:
    """Alerting features and the largest PSI, in one row."""
    alerting = F.when(F.col("status") == "alert", F.col("feature"))
    return drift.agg(
        F.array_join(F.array_sort(F.collect_set(alerting)), ",").alias("alerting"),
        F.count_if(F.col("status") == "alert").alias("n_alerts"),
        F.max(F.when(~F.isnan("psi"), F.col("psi"))).alias("max_psi"),
    )
