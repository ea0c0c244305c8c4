"""Reproducible synthetic and perturbed columns on an existing keyed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import keyed as K
from ..functions.scalar import clip, clock, join_labels, remote_province, replace_hour
from ..schemas import require_columns

CITY_VALUES = [city for _, cities in C.PROVINCES.values() for city in cities]
CITY_WEIGHTS = [w / len(cities) for w, cities in C.PROVINCES.values() for _ in cities]

REQUIRED_TX = ["transaction_id", "user_id", "amount", "transaction_date", "transaction_time",
               "province", "city", "card_type", "device_type", "is_weekend", "hour_of_day",
               "day_of_month"]


def _with_uniforms(df: DataFrame, key: Column, salts: list[str]) -> DataFrame:
    return df.withColumns({f"_u_{s}": K.uniform(key, s) for s in salts})


def _u(salt: str) -> Column:
    return F.col(f"_u_{salt}")


def _drop_uniforms(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_u_")])


def city_dimension(spark) -> DataFrame:
    """The fixed city -> province look-up (48 rows at most)."""
    rows = [(city, prov) for prov, (_, cities) in C.PROVINCES.items() for city in cities]
    rows += [(c, C.SISTAN if c in C.SISTAN_CITIES else C.HORMOZGAN) for c in C.REMOTE_CITIES]
    return spark.createDataFrame(rows, "city string, province string")


def city_to_province(df: DataFrame, city: str = "city", out: str = "province") -> DataFrame:
    """Attach the province of a city; the dimension is fixed, hence safe to broadcast."""
    dim = city_dimension(df.sparkSession).withColumnsRenamed({"city": city, "province": out})
    return df.join(F.broadcast(dim), city, "left")


def assign_weighted(df: DataFrame, key: str, out: str, values: list, weights: list[float],
                    salt: str | None = None) -> DataFrame:
    """A weighted category per key."""
    salt = salt or out
    return _drop_uniforms(_with_uniforms(df, F.col(key), [salt])
                          .withColumn(out, K.pick(_u(salt), values, weights)))


def assign_location(df: DataFrame, key: str) -> DataFrame:
    """A city by province weight and its province."""
    return city_to_province(assign_weighted(df, key, "city", CITY_VALUES, CITY_WEIGHTS))


def assign_card(df: DataFrame, key: str, out: str = "card_type") -> DataFrame:
    return assign_weighted(df, key, out, list(C.CARDS), [w for w, _ in C.CARDS.values()])


def assign_device(df: DataFrame, key: str, out: str = "device_type") -> DataFrame:
    return assign_weighted(df, key, out, list(C.DEVICES), list(C.DEVICES.values()))


def draw_beta_int(df: DataFrame, key: str, out: str, a: int, b: int, low: float,
                  high: float) -> DataFrame:
    """round(low + (high-low) * Beta(a, b))."""
    beta = K.beta_order_statistic(
        [K.uniform(key, f"{out}{i}") for i in range(a + b - 1)], a)
    return df.withColumn(out, F.round(beta * F.lit(float(high - low)) + F.lit(float(low)))
                         .cast("int"))


def draw_age(df: DataFrame, key: str, out: str = "age") -> DataFrame:
    return draw_beta_int(df, key, out, 2, 5, C.AGE_MIN, C.AGE_MAX)


def draw_amount(df: DataFrame, key: str, card: str | None = "card_type",
                age: str | None = "age", out: str = "amount", mu: float = C.AMOUNT_LOG_MEAN,
                sigma: float = C.AMOUNT_LOG_SIGMA, low: float = C.AMOUNT_MIN,
                high: float = C.AMOUNT_MAX) -> DataFrame:
    """Log-normal amount shifted by card multiplier and age, clipped, rounded to integer."""
    mean = F.lit(float(mu))
    if card:
        factor = None
        for name, (_, mult) in C.CARDS.items():
            factor = (F if factor is None else factor).when(F.col(card) == name, F.lit(mult))
        mean = mean + F.ln(factor.otherwise(F.lit(1.0)))
    if age:
        # An unknown age leaves the mean as it is.
        mean = mean + F.coalesce(
            F.ln(clip(F.lit(1.0) + (F.col(age) - F.lit(30)) * F.lit(0.02), 0.5, 2.0)), F.lit(0.0))
    z = K.normal(_u(f"{out}a"), _u(f"{out}b"))
    value = F.round(clip(F.exp(mean + F.lit(float(sigma)) * z), float(low), float(high)))
    return _drop_uniforms(_with_uniforms(df, F.col(key), [f"{out}a", f"{out}b"])
                          .withColumn(out, value.cast("bigint")))


def draw_poisson(df: DataFrame, key: str, out: str = "daily_count",
                 rate: float = C.DAILY_RATE) -> DataFrame:
    return _drop_uniforms(_with_uniforms(df, F.col(key), [out])
                          .withColumn(out, K.poisson(_u(out), rate)))


def draw_hour(df: DataFrame, key: str, out: str = "hour_of_day") -> DataFrame:
    """Active hours round(6 + 16*Beta(3,2)); one in ten in the small hours or late evening."""
    active = K.beta_order_statistic(
        [K.uniform(key, f"{out}{i}") for i in range(4)], 3) * F.lit(16.0) + F.lit(6.0)
    small = _u(f"{out}_small") * F.lit(6.0)
    off = F.when(_u(f"{out}_late") < 0.5, small).otherwise(small + F.lit(22.0))
    hour = F.when(_u(f"{out}_off") < 0.1, off).otherwise(active)
    salts = [f"{out}_{s}" for s in ("small", "late", "off")]
    return _drop_uniforms(_with_uniforms(df, F.col(key), salts)
                          .withColumn(out, clip(F.round(hour), 0.0, 23.0).cast("int")))


def draw_date_time(df: DataFrame, key: str, hour: str = "hour_of_day",
                   start=C.START_DATE, end=C.END_DATE) -> DataFrame:
    """A date in [start, end] and a time HH:MM:SS within the given hour."""
    span = (end - start).days + 1
    return _drop_uniforms(
        _with_uniforms(df, F.col(key), ["date", "minute", "second"])
        .withColumns({
            "transaction_date": F.date_add(F.lit(start), K.scaled_int(_u("date"), 0, span - 1)),
            "transaction_time": clock(F.col(hour), K.scaled_int(_u("minute"), 0, 59),
                                      K.scaled_int(_u("second"), 0, 59))}))


def keep_or_redraw(df: DataFrame, key: str) -> DataFrame:
    """Home city with probability .8, own card .7, own device .6, otherwise a fresh draw.

    Needs city, province, preferred_card_type and primary_device.
    """
    salts = ["keep_city", "keep_card", "keep_device", "city", "card_type", "device_type"]
    drawn = _with_uniforms(df, F.col(key), salts).withColumns({
        "_city": K.pick(_u("city"), CITY_VALUES, CITY_WEIGHTS),
        "_card": K.pick(_u("card_type"), list(C.CARDS), [w for w, _ in C.CARDS.values()]),
        "_device": K.pick(_u("device_type"), list(C.DEVICES), list(C.DEVICES.values()))})
    home = _u("keep_city") < 0.8
    out = city_to_province(drawn, "_city", "_province").withColumns({
        "city": F.when(home, F.col("city")).otherwise(F.col("_city")),
        "province": F.when(home, F.col("province")).otherwise(F.col("_province")),
        "card_type": F.when(_u("keep_card") < 0.7, F.col("preferred_card_type"))
        .otherwise(F.col("_card")),
        "device_type": F.when(_u("keep_device") < 0.6, F.col("primary_device"))
        .otherwise(F.col("_device"))})
    return _drop_uniforms(out.drop("_city", "_card", "_device", "_province"))


def with_user_age(tx: DataFrame, users: DataFrame, default: int = 30) -> DataFrame:
    """Transactions with the user's age, `default` when the user or the age is unknown."""
    return (tx.join(users.select("user_id", "age"), "user_id", "left")
            .withColumn("age", F.coalesce(F.col("age"), F.lit(default))))


def perturb_transactions(tx: DataFrame, users: DataFrame, rates: dict | None = None,
                         key: str = "transaction_id") -> DataFrame:
    """Change a controlled share of rows and label them.

    location: a remote city; age_amount: 5-20M for users under 25; time: an hour from 2 to 5,
    also in the time text; amount: 70 % 30-100M, else 100-800, never on age_amount rows.
    """
    require_columns(tx, REQUIRED_TX)
    rates = {**C.NOISE_RATES, **(rates or {})}
    salts = ["n_loc", "n_age", "n_time", "n_amt", "n_side", "v_city", "v_age", "v_hour", "v_amt"]
    df = _with_uniforms(with_user_age(tx, users), F.col(key), salts)
    location, young, time, amount = C.NOISE_LABELS
    df = df.withColumns({
        "_loc": _u("n_loc") < rates["location"],
        "_age": (F.col("age") < 25) & (_u("n_age") < rates["age_amount"]),
        "_time": _u("n_time") < rates["time"],
        "_city": K.pick(_u("v_city"), C.REMOTE_CITIES),
        "_hour": K.scaled_int(_u("v_hour"), 2, 5),
    }).withColumn("_amt", ~F.col("_age") & (_u("n_amt") < rates["amount"]))
    outlier = F.when(_u("n_side") < 0.7, F.lit(3e7) + _u("v_amt") * F.lit(7e7)).otherwise(
        F.lit(100.0) + _u("v_amt") * F.lit(700.0))
    remote = remote_province(F.col("_city"), C.SISTAN_CITIES, C.SISTAN, C.HORMOZGAN)
    changed = {
        "province": F.when(F.col("_loc"), remote).otherwise(F.col("province")),
        "city": F.when(F.col("_loc"), F.col("_city")).otherwise(F.col("city")),
        "amount": F.when(F.col("_age"), F.lit(5e6) + _u("v_age") * F.lit(1.5e7))
        .when(F.col("_amt"), outlier).otherwise(F.col("amount")),
        "hour_of_day": F.when(F.col("_time"), F.col("_hour")).otherwise(F.col("hour_of_day")),
        "transaction_time": F.when(F.col("_time"), replace_hour(
            F.col("transaction_time"), F.col("_hour"))).otherwise(F.col("transaction_time")),
        "is_noise": F.col("_loc") | F.col("_age") | F.col("_time") | F.col("_amt"),
        "noise_type": join_labels(F.when(F.col("_loc"), location), F.when(F.col("_age"), young),
                                  F.when(F.col("_time"), time), F.when(F.col("_amt"), amount)),
    }
    kept = [c for c in tx.columns if c not in changed]
    return df.select(*kept, *[v.alias(k) for k, v in changed.items()])


def perturb_users(users: DataFrame, age_rate: float = 0.01, city_rate: float = 0.02,
                  key: str = "user_id") -> DataFrame:
    """Implausible ages (birth_year stays) and remote home cities for a share of users."""
    df = _with_uniforms(users, F.col(key), ["p_age", "p_age_v", "p_city", "p_city_v"])
    df = df.withColumn("_city", K.pick(_u("p_city_v"), C.REMOTE_CITIES))
    hit = _u("p_city") < city_rate
    remote = remote_province(F.col("_city"), C.SISTAN_CITIES, C.SISTAN, C.HORMOZGAN)
    return _drop_uniforms(df.withColumns({
        "age": F.when(_u("p_age") < age_rate, K.pick(_u("p_age_v"), C.NOISY_AGES))
        .otherwise(F.col("age")).cast("int"),
        "province": F.when(hit, remote).otherwise(F.col("province")),
        "city": F.when(hit, F.col("_city")).otherwise(F.col("city"))}).drop("_city"))


def expand_rows(users: DataFrame, low: int = C.ROWS_PER_USER[0], high: int = C.ROWS_PER_USER[1],
                key: str = "user_id") -> DataFrame:
    """n rows per user, n uniform in [low, high]; `row_key` names the new row."""
    n = K.scaled_int(K.uniform(key, "rows"), low, high)
    return (users.withColumn("row_no", F.explode(F.sequence(F.lit(1), n)))
            .withColumn("row_key", F.concat_ws("/", F.col(key), F.col("row_no"))))


def user_attributes(ids: DataFrame, key: str = "user_id", perturbed: bool = True) -> DataFrame:
    """Age, birth year, registration date, home place, card and device for a table of ids."""
    df = assign_device(assign_card(assign_location(draw_age(ids, key), key), key,
                                   "preferred_card_type"), key, "primary_device")
    df = _drop_uniforms(_with_uniforms(df, F.col(key), ["reg"]).withColumns({
        "birth_year": (F.lit(C.REFERENCE_YEAR) - F.col("age")).cast("int"),
        "registration_date": F.date_sub(F.lit(C.START_DATE), K.scaled_int(_u("reg"), 180, 1824))}))
    return perturb_users(df, key=key) if perturbed else df


def synthesise_transactions(users: DataFrame, low: int = C.ROWS_PER_USER[0],
                            high: int = C.ROWS_PER_USER[1]) -> DataFrame:
    """A month of card transactions for a table of users, keyed by (user, row number)."""
    df = keep_or_redraw(expand_rows(users, low, high), "row_key")
    df = draw_date_time(draw_hour(draw_amount(df, "row_key"), "row_key"), "row_key")
    date = F.col("transaction_date")
    return df.select(
        "row_key", "user_id", "row_no", F.col("amount").cast("double").alias("amount"),
        "transaction_date", "transaction_time", "province", "city", "card_type", "device_type",
        (F.dayofweek(date) == 6).alias("is_weekend"), "hour_of_day",
        F.dayofmonth(date).alias("day_of_month"))
