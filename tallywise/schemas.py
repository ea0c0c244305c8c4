"""Explicit schemas of the six tables."""

from pyspark.sql import types as T

_long, _int, _dbl, _str, _bool = (
    T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.BooleanType())


def _struct(required: list, optional: list) -> T.StructType:
    return T.StructType([T.StructField(n, t, False) for n, t in required]
                        + [T.StructField(n, t, True) for n, t in optional])


USERS = _struct(
    [("user_id", _long), ("age", _int), ("birth_year", _int), ("registration_date", T.DateType()),
     ("province", _str), ("city", _str), ("preferred_card_type", _str), ("primary_device", _str)],
    [("created_at", T.TimestampType())])

TRANSACTIONS = _struct(
    [("transaction_id", _long), ("user_id", _long), ("amount", _dbl),
     ("transaction_date", T.DateType()), ("transaction_time", _str), ("province", _str),
     ("city", _str), ("card_type", _str), ("device_type", _str), ("is_weekend", _bool),
     ("hour_of_day", _int), ("day_of_month", _int)],
    [("is_noise", _bool), ("noise_type", _str), ("created_at", T.TimestampType())])

FEATURE_COLUMNS = [
    ("total_transactions", _long), ("total_amount", _dbl), ("avg_transaction_amount", _dbl),
    ("std_transaction_amount", _dbl), ("min_transaction_amount", _dbl),
    ("max_transaction_amount", _dbl), ("median_transaction_amount", _dbl),
    ("avg_hour_of_day", _dbl), ("std_hour_of_day", _dbl), ("weekend_transaction_ratio", _dbl),
    ("night_transaction_ratio", _dbl), ("transaction_frequency", _dbl),
    ("unique_cities_count", _long), ("unique_provinces_count", _long),
    ("most_frequent_city", _str), ("most_frequent_province", _str),
    ("geographical_diversity", _dbl), ("card_type_diversity", _dbl),
    ("device_type_diversity", _dbl), ("regularity_score", _dbl),
    ("amount_percentile_25", _dbl), ("amount_percentile_75", _dbl), ("amount_iqr", _dbl),
    ("amount_skewness", _dbl), ("age", _int), ("birth_year", _int)]

USER_FEATURES = _struct(
    [("user_id", _long)],
    FEATURE_COLUMNS + [("spending_category", _str), ("behavior_cluster", _int),
                       ("anomaly_score", _dbl), ("is_anomaly", _bool)])

SIMILARITY_RESULTS = _struct(
    [("query_user_id", _long), ("similar_user_id", _long), ("similarity_score", _dbl),
     ("similarity_method", _str)], [])

CLUSTERING_RESULTS = _struct(
    [("user_id", _long), ("cluster_id", _long), ("cluster_method", _str)],
    [("distance_to_center", _dbl), ("cluster_probability", _dbl)])

ANOMALY_RESULTS = _struct(
    [("user_id", _long), ("anomaly_method", _str), ("anomaly_score", _dbl), ("is_anomaly", _bool)],
    [("shap_values", T.MapType(_str, _dbl)), ("feature_importance", T.MapType(_str, _dbl))])

TABLES = {
    "users": USERS, "transactions": TRANSACTIONS, "user_features": USER_FEATURES,
    "similarity_results": SIMILARITY_RESULTS, "clustering_results": CLUSTERING_RESULTS,
    "anomaly_results": ANOMALY_RESULTS,
}


def require_columns(df, names) -> None:
    """Fail at plan time when a needed column is absent."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(sorted(missing))}")


def column_kinds(df, identifiers=("user_id", "vec_id")) -> dict[str, list[str]]:
    """Split the columns into identifier, categorical and numerical.

    Flags, dates and timestamps are in none of the three: they are never scaled.
    """
    kinds = {"identifier": [], "categorical": [], "numerical": []}
    for field in df.schema.fields:
        if field.name in identifiers:
            kinds["identifier"].append(field.name)
        elif isinstance(field.dataType, T.StringType):
            kinds["categorical"].append(field.name)
        elif isinstance(field.dataType, T.NumericType):
            kinds["numerical"].append(field.name)
    return kinds
