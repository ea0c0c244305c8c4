"""The tables that queries start from, and rounding for cross-engine comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import features as feat
from ..schemas import FEATURE_COLUMNS
from ..sources import tables

FLOAT_FEATURES = [n for n, t in FEATURE_COLUMNS if t.simpleString() == "double"]
INT_FEATURES = [n for n, t in FEATURE_COLUMNS if t.simpleString() in ("bigint", "int")]
TEXT_FEATURES = [n for n, t in FEATURE_COLUMNS if t.simpleString() == "string"]

users = tables.users
tx = tables.transactions
ltx = tables.labelled_transactions
vectors = tables.vectors


def feats(spark, folder) -> DataFrame:
    return feat.user_features(users(spark, folder), tx(spark, folder))


def lfeats(spark, folder) -> DataFrame:
    return feat.user_features(users(spark, folder), ltx(spark, folder))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, so that summation order does not show."""
    return df.selectExpr(*[
        f"round(`{f.name}`, {digits}) as `{f.name}`" if f.dataType.simpleString() == "double"
        else f"`{f.name}`" for f in df.schema.fields])
