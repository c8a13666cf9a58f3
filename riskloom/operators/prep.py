"""Model preparation fitted on the training rows and applied as plain expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.config import NOMINAL_COLUMNS
from riskloom.operators.ranks import exact_quantiles, running_totals
from riskloom.session import materialise

# More levels than this, unless the caller allows more, means the column is not nominal.
MAX_LEVELS = 1000


@dataclass(frozen=True)
class Preparation:
    """Fitted levels per nominal column and statistics per numeric column."""

    levels: dict[str, tuple[int, ...]]
    medians: dict[str, float | None]
    means: dict[str, float]
    deviations: dict[str, float]
    lowest: dict[str, float]

    def one_hot(self) -> dict[str, str]:
        """An indicator per level after the first; an unknown level gives all zeros."""
        return {
            f"{c}_{level}": f"if({c} <=> {level}, 1.0D, 0.0D)"
            for c, levels in self.levels.items()
            for level in levels[1:]
        }

    def imputed(self) -> dict[str, str]:
        return {
            c: f"coalesce(cast({c} as double), {_number(m)})" for c, m in self.medians.items()
        }

    def standardised(self) -> dict[str, str]:
        return {
            c: f"({text} - {_number(self.means[c])}) / {_number(self.deviations[c])}"
            for c, text in self.imputed().items()
        }

    def with_sentinel(self) -> dict[str, str]:
        """For trees, which have no branch for a missing value: one below the minimum."""
        return {
            c: f"coalesce(cast({c} as double), {_number(low - 1.0)})"
            for c, low in self.lowest.items()
        }

    def with_missing(self) -> dict[str, str]:
        """For trees that have a branch for a missing value: NaN."""
        return {c: f"coalesce(cast({c} as double), double('NaN'))" for c in self.lowest}

    def stages(self, numeric: dict[str, str]) -> PipelineModel:
        """Stages that add the vector ``features``; they save like any built-in stage."""
        columns = {**self.one_hot(), **numeric}
        names = [f"x_{c}" for c in columns]
        text = ", ".join(f"{expr} AS x_{c}" for c, expr in columns.items())
        select = SQLTransformer(statement=f"SELECT *, {text} FROM __THIS__")
        assemble = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
        return PipelineModel([select, assemble])


def _number(value: float | None) -> str:
    return "0.0D" if value is None else f"double('{float(value)!r}')"


def fit_levels(
    train: DataFrame, nominal: Sequence[str] = NOMINAL_COLUMNS, max_levels: int = MAX_LEVELS
) -> dict[str, tuple]:
    """Sorted levels of each nominal column; refuses a column with more than ``max_levels``."""
    out = {}
    for c in nominal:
        found = train.select(c).filter(F.col(c).isNotNull()).distinct().limit(max_levels + 1)
        levels = sorted(r[c] for r in found.collect())
        if len(levels) > max_levels:
            raise ValueError(f"{c} has more than {max_levels} levels")
        out[c] = tuple(levels)
    return out


def fit_preparation(
    train: DataFrame, columns: Sequence[str], nominal: Sequence[str] = NOMINAL_COLUMNS
) -> Preparation:
    """Levels, exact medians, and the mean and population deviation after imputation.

    Reads ``train`` a few times: hand in a stored table or a materialised frame.
    """
    nominal = [c for c in nominal if c in columns]
    numeric = [c for c in columns if c not in nominal]
    medians = {c: q.values[0] for c, q in exact_quantiles(train, numeric, ["0.5"]).items()}
    aggregates = []
    for k, c in enumerate(numeric):
        filled = f"coalesce(cast({c} as double), {_number(medians[c])})"
        aggregates += [
            f"avg({filled}) AS mean{k}",
            f"stddev_pop({filled}) AS deviation{k}",
            f"min(cast({c} as double)) AS lowest{k}",
        ]
    row = train.agg(*map(F.expr, aggregates)).first()
    return Preparation(
        levels=fit_levels(train, nominal),
        medians=medians,
        means={c: row[f"mean{k}"] or 0.0 for k, c in enumerate(numeric)},
        # A constant column is centred and left unscaled.
        deviations={c: row[f"deviation{k}"] or 1.0 for k, c in enumerate(numeric)},
        lowest={c: row[f"lowest{k}"] or 0.0 for k, c in enumerate(numeric)},
    )


def apply_columns(df: DataFrame, columns: dict[str, str], keep: Sequence[str]) -> DataFrame:
    """Prepared columns as a plain frame."""
    return df.selectExpr(*keep, *(f"{text} AS {name}" for name, text in columns.items()))


def class_weights(df: DataFrame, label: str = "default_next_month") -> DataFrame:
    """Balanced weight per class, n / (2 n_class), and n_neg / n_pos for a network."""
    counts = df.agg(
        F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")
    )
    pair = ", ".join(
        f"named_struct('label', {k}, 'n', n{k}, 'weight', (n0 + n1) / (2.0D * nullif(n{k}, 0)), "
        "'pos_weight', n0 / cast(greatest(n1, 1) as double))"
        for k in (0, 1)
    )
    return counts.selectExpr(f"inline(array({pair}))").filter("n > 0")


def with_class_weight(df: DataFrame, label: str = "default_next_month") -> DataFrame:
    """Add ``weight`` per row from two counted numbers."""
    weights = {r["label"]: r["weight"] for r in class_weights(df, label).collect()}
    positive, negative = _number(weights.get(1)), _number(weights.get(0))
    return df.withColumn("weight", F.expr(f"if({label} = 1, {positive}, {negative})"))


def with_copies(df: DataFrame, label: str = "default_next_month") -> DataFrame:
    """Add ``copies``: n_neg / n_pos (rounded) for a positive, 1 for a negative."""
    rows = class_weights(df, label).collect()
    copies = max(round(rows[0]["pos_weight"]), 1) if len(rows) == 2 else 1
    return df.withColumn("copies", F.expr(f"if({label} = 1, {copies}, 1)"))


def oversample_positives(df: DataFrame, label: str = "default_next_month") -> DataFrame:
    """Repeat each positive n_neg / n_pos times (rounded), for a learner without weights."""
    repeated = F.expr("explode(sequence(1, copies))")
    return with_copies(df, label).select("*", repeated.alias("copy")).drop("copies")


def stratified_folds(
    df: DataFrame, folds: int, seed: int, label: str = "default_next_month"
) -> DataFrame:
    """Add ``fold``: the rank within the label by a seeded hash of the id, modulo ``folds``.

    Exactly balanced, and ranked by running totals rather than one task per label.
    """
    keyed = df.select(
        "client_id",
        F.col(label).alias("_label"),
        F.xxhash64(F.col("client_id"), F.lit(seed)).alias("_order"),
        F.lit(1).cast("bigint").alias("one"),
    )
    ranked = running_totals(materialise(keyed), "_order", ["one"], ["_label"])
    fold = ranked.select("client_id", (F.col("before_one") % folds).cast("int").alias("fold"))
    return df.join(fold, "client_id")
