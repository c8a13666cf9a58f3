"""Feature table: clean rows to features, label and split, without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.config import NON_MODEL_COLUMNS, SplitRule
from riskloom.functions.features import FAMILIES, aliased, all_features, helper_columns


def split_bucket(rule: SplitRule, client_id: str = "client_id") -> str:
    """``client_id * multiplier mod modulus``, reduced first so that it cannot overflow."""
    factor = rule.multiplier % rule.modulus
    return f"((({client_id} % {rule.modulus}L) * {factor}L) % {rule.modulus}L)"


def split_name(rule: SplitRule, client_id: str = "client_id") -> str:
    """train, valid or test; depends on the id alone. A negative id lands in train."""
    bucket = split_bucket(rule, client_id)
    return (
        f"CASE WHEN {bucket} <= {rule.train_max} THEN 'train' "
        f"WHEN {bucket} <= {rule.valid_max} THEN 'valid' ELSE 'test' END"
    )


def features(
    clean: DataFrame, rule: SplitRule | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """The feature table, then any further columns in ``keep``. Safe on a stream."""
    columns = all_features()
    ordered = {"client_id": "client_id", "limit_bal": columns.pop("limit_bal"), "sex": "sex"}
    ordered.update(columns)
    ordered["default_next_month"] = "default_next_month"
    ordered["split_name"] = split_name(rule or SplitRule())
    ordered.update({c: c for c in keep if c not in ordered})
    return clean.selectExpr(*aliased(ordered))


def feature_family(clean: DataFrame, family: str) -> DataFrame:
    """``client_id`` and one family of features."""
    return clean.selectExpr("client_id", *aliased(FAMILIES[family]()))


def helpers(clean: DataFrame) -> DataFrame:
    """``client_id`` and the per-month helper columns."""
    return clean.selectExpr("client_id", *aliased(helper_columns()))


def split_frame(features_df: DataFrame, name: str) -> DataFrame:
    """One split of the feature table."""
    return features_df.filter(F.col("split_name") == name)


def model_columns(df: DataFrame, excluded: Sequence[str] = NON_MODEL_COLUMNS) -> list[str]:
    """Model inputs: every column but ids, label, split and the protected attribute."""
    return [c for c in df.columns if c not in excluded]
