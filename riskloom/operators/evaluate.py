"""Threshold, cost and ranking metrics from one frame of tied score counts.

Everything here reads ``ranked_scores``: one row per distinct score and group with the
counts at that score and above it. Its size follows the distinct scores, not the rows.
Score frames hold ``y`` (0/1), ``p`` and the grouping columns named in ``by``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import SWEEP_RATIOS, CostMatrix
from riskloom.operators.ranks import running_totals
from riskloom.session import materialise

# x + x * _HALF_STEP rounds to the next double above x for every positive normal x.
_HALF_STEP = 2.0**-53 + 2.0**-105
_SMALLEST = 5e-324


def next_double(x: Column) -> Column:
    """Smallest double above a non-negative ``x``."""
    return F.greatest(x + x * F.lit(_HALF_STEP), F.lit(_SMALLEST))


def tied_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows ``n`` and positives ``pos`` per group and distinct score."""
    return scored.groupBy(*by, "p").agg(
        F.count("*").alias("n"), F.sum("y").cast("bigint").alias("pos")
    )


def ranked_scores(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Tied counts with running counts from the highest score down."""
    counts = materialise(tied_counts(scored, by))
    return running_totals(counts, "p", ["n", "pos"], by, descending=True)


def safe_ratio(numerator: Column, denominator: Column, empty: float | None = 0.0) -> Column:
    """Double division with ``empty`` where the denominator is zero."""
    value = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return value if empty is None else F.coalesce(value, F.lit(empty))


def confusion(scored: DataFrame, threshold: float | Column, by: Sequence[str] = ()) -> DataFrame:
    """Outcome counts when ``p >= threshold`` is acted on."""
    hit, positive = F.col("p") >= threshold, F.col("y") == 1
    return scored.groupBy(*by).agg(
        F.count_if(~positive & ~hit).alias("tn"),
        F.count_if(~positive & hit).alias("fp"),
        F.count_if(positive & ~hit).alias("fn"),
        F.count_if(positive & hit).alias("tp"),
    )


def cost_curve(ranked: DataFrame, cost: CostMatrix, by: Sequence[str] = ()) -> DataFrame:
    """Cost at every distinct score, and at the point just above that flags nobody.

    The top row of a group emits both points, so no union and no second pass is needed.
    """
    flagged = F.col("before_n") + F.col("n")
    caught = F.col("before_pos") + F.col("pos")
    here = F.struct(F.col("p").alias("threshold"), flagged.alias("flagged"), caught.alias("tp"))
    nobody = F.struct(
        next_double(F.col("p")).alias("threshold"),
        F.lit(0).cast("bigint").alias("flagged"),
        F.lit(0).cast("bigint").alias("tp"),
    )
    points = F.when(F.col("before_n") == 0, F.array(nobody, here)).otherwise(F.array(here))
    tp = F.col("point.tp")
    fp = F.col("point.flagged") - tp
    fn = F.col("total_pos") - tp
    tn = F.col("total_n") - F.col("total_pos") - fp
    return ranked.withColumn("point", F.explode(points)).select(
        *by,
        F.col("point.threshold").alias("threshold"),
        tn.alias("tn"),
        fp.alias("fp"),
        fn.alias("fn"),
        tp.alias("tp"),
        cost.expected_cost(tn=tn, fp=fp, fn=fn, tp=tp).alias("cost"),
    )


def optimal_threshold(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cheapest threshold per group; among equals the highest."""
    best = F.min(F.struct("cost", (-F.col("threshold")).alias("minus"))).alias("best")
    return (
        curve.groupBy(*by)
        .agg(best)
        .filter(F.col("best").isNotNull())
        .select(*by, (-F.col("best.minus")).alias("threshold"), F.col("best.cost").alias("cost"))
    )


def fit_threshold(scored: DataFrame, cost: CostMatrix) -> float:
    """The cheapest threshold of a frame, as a number to decide with."""
    best = optimal_threshold(cost_curve(ranked_scores(scored), cost)).first()
    if best is None:
        raise ValueError("cannot choose a threshold without scores")
    return best["threshold"]


def baseline_costs(scored: DataFrame, cost: CostMatrix, by: Sequence[str] = ()) -> DataFrame:
    """Cost of acting on nobody and on everybody."""
    pos, neg = F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)
    return scored.groupBy(*by).agg(
        (pos * cost.false_negative + neg * cost.true_negative).alias("intervene_none"),
        (pos * cost.true_positive + neg * cost.false_positive).alias("intervene_all"),
    )


def _roc_auc() -> Column:
    """Chance that a positive outranks a negative, ties counting half."""
    neg = (F.col("n") - F.col("pos")).cast("double")
    wins = F.sum(neg * (F.col("before_pos") + F.col("pos") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum(neg)
    return F.try_divide(wins, pairs)


def _average_precision() -> Column:
    """Step-wise: precision at each distinct score weighted by the recall it adds."""
    precision = (F.col("before_pos") + F.col("pos")) / (F.col("before_n") + F.col("n"))
    return safe_ratio(F.sum(F.col("pos") * precision), F.sum("pos"))


def _brier() -> Column:
    p, n, pos = F.col("p"), F.col("n"), F.col("pos")
    return F.sum(pos * (p - 1.0) * (p - 1.0) + (n - pos) * p * p) / F.sum("n")


def ranking_metrics(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC, average precision and Brier score per group."""
    return ranked.groupBy(*by).agg(
        F.sum("n").cast("bigint").alias("n"),
        _roc_auc().alias("roc_auc"),
        _average_precision().alias("pr_auc"),
        _brier().alias("brier"),
    )


def metrics(
    ranked: DataFrame, cost: CostMatrix, threshold: float | Column, by: Sequence[str] = ()
) -> DataFrame:
    """The full metric row per group, in one aggregation over the tied counts."""
    threshold = F.lit(threshold) if isinstance(threshold, (int, float)) else threshold
    hit = F.col("p") >= threshold
    neg = F.col("n") - F.col("pos")

    def counted(count: Column, test: Column) -> Column:
        return F.sum(F.when(test, count).otherwise(0)).cast("bigint")

    base = ranked.groupBy(*by).agg(
        F.sum("n").cast("bigint").alias("n"),
        F.sum("pos").cast("bigint").alias("pos"),
        F.max(threshold).alias("threshold"),
        _roc_auc().alias("roc_auc"),
        _average_precision().alias("pr_auc"),
        _brier().alias("brier"),
        counted(neg, ~hit).alias("tn"),
        counted(neg, hit).alias("fp"),
        counted(F.col("pos"), ~hit).alias("fn"),
        counted(F.col("pos"), hit).alias("tp"),
    ).filter("n > 0")
    tn, fp, fn, tp, n, pos = (F.col(c) for c in ("tn", "fp", "fn", "tp", "n", "pos"))
    total = cost.expected_cost(tn=tn, fp=fp, fn=fn, tp=tp)
    none = cost.expected_cost(tn=n - pos, fp=F.lit(0), fn=pos, tp=F.lit(0))
    everyone = cost.expected_cost(tn=F.lit(0), fp=n - pos, fn=F.lit(0), tp=pos)
    saved = F.least(none, everyone) - total
    return base.select(
        *by,
        "n",
        safe_ratio(pos, n).alias("positive_rate"),
        "threshold",
        "roc_auc",
        "pr_auc",
        "brier",
        safe_ratio(tp + tn, n).alias("accuracy"),
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(tp * 2, tp * 2 + fp + fn).alias("f1"),
        "tn",
        "fp",
        "fn",
        "tp",
        total.alias("total_cost"),
        (total / n).alias("cost_per_client"),
        none.alias("baseline_intervene_none"),
        everyone.alias("baseline_intervene_all"),
        saved.alias("savings_vs_best_baseline"),
        (safe_ratio(saved, F.least(none, everyone)) * 100).alias("savings_pct"),
    )


def fairness(
    scored: DataFrame,
    threshold: float,
    group: str = "sex",
    labels: dict[int, str] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Per-group performance; ROC-AUC is NULL where a group has one class only."""
    keys = [*by, group]
    report = metrics(ranked_scores(scored, keys), CostMatrix(), threshold, keys)
    label = F.col(group).cast("string")
    for code, name in (labels or {}).items():
        label = F.when(F.col(group) == code, name).otherwise(label)
    return report.select(
        *by,
        F.col(group).alias("code"),
        label.alias("group"),
        "n",
        F.col("positive_rate").alias("actual_default_rate"),
        safe_ratio(F.col("tp") + F.col("fp"), F.col("n")).alias("selection_rate"),
        "recall",
        "precision",
        "roc_auc",
    )


def cost_sweep(
    fit: DataFrame,
    apply_to: DataFrame,
    cost: CostMatrix,
    ratios: Sequence[float] = SWEEP_RATIOS,
) -> DataFrame:
    """Operating point per cost ratio, chosen on ``fit`` and measured on ``apply_to``.

    Both are ``ranked_scores``. All ratios share one pass over each: the cheapest point
    of every ratio is its own aggregate, and the chosen thresholds (one per ratio) come
    back as literals.
    """
    curve = cost_curve(fit, cost)
    choose = []
    for k, ratio in enumerate(ratios):
        total = cost.with_ratio(ratio).expected_cost(**{c: F.col(c) for c in ("tn", "fp", "fn", "tp")})
        best = F.min(F.struct(total.alias("cost"), (-F.col("threshold")).alias("minus")))
        choose.append((-best["minus"]).alias(f"t{k}"))
    chosen = curve.agg(*choose).first()
    if chosen["t0"] is None:
        raise ValueError("cannot choose thresholds without scores")

    neg = F.col("n") - F.col("pos")
    sums = [F.sum("n").alias("n"), F.sum("pos").alias("pos")]
    for k in range(len(ratios)):
        hit = F.col("p") >= chosen[f"t{k}"]
        sums.append(F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias(f"tp{k}"))
        sums.append(F.sum(F.when(hit, neg).otherwise(0)).alias(f"fp{k}"))
    rows = []
    for k, ratio in enumerate(ratios):
        matrix = cost.with_ratio(ratio)
        tp, fp = F.col(f"tp{k}"), F.col(f"fp{k}")
        fn, tn = F.col("pos") - tp, F.col("n") - F.col("pos") - fp
        none = matrix.expected_cost(tn=tn + fp, fp=F.lit(0), fn=tp + fn, tp=F.lit(0))
        everyone = matrix.expected_cost(tn=F.lit(0), fp=tn + fp, fn=F.lit(0), tp=tp + fn)
        best = F.least(none, everyone)
        saved = best - matrix.expected_cost(tn=tn, fp=fp, fn=fn, tp=tp)
        rows.append(
            F.struct(
                F.lit(float(ratio)).alias("fn_fp_ratio"),
                F.lit(chosen[f"t{k}"]).alias("threshold"),
                (safe_ratio(tp + fp, F.col("n")) * 100).alias("flagged_pct"),
                safe_ratio(tp, tp + fn).alias("recall"),
                safe_ratio(tp, tp + fp).alias("precision"),
                (safe_ratio(saved, best) * 100).alias("savings_pct"),
            )
        )
    return apply_to.agg(*sums).select(F.inline(F.array(*rows)))


def compare_models(
    scored: dict[str, DataFrame], cost: CostMatrix, thresholds: dict[str, float]
) -> DataFrame:
    """One metric row per model flavour."""
    out = None
    for flavor, frame in scored.items():
        row = metrics(ranked_scores(frame), cost, thresholds[flavor]).select(
            F.lit(flavor).alias("flavor"), "*"
        )
        out = row if out is None else out.unionByName(row)
    if out is None:
        raise ValueError("no models to compare")
    return out
