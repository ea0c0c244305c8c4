"""Reproducible column synthesis and labelled perturbation on the given tables."""

import math

from pyspark.sql import functions as F

from ..functions.keyed import poisson_bounds
from ..operators import synth as s
from .. import constants as C
from . import sqltext as S
from .inputs import tx, users
from .registry import query

CARDS, CARD_W = list(C.CARDS), [w for w, _ in C.CARDS.values()]
DEVICES, DEVICE_W = list(C.DEVICES), list(C.DEVICES.values())
_DIM = " union all ".join(f"select '{c}' as city, '{p}' as province"
                          for p, (_, cities) in C.PROVINCES.items() for c in cities)


def _beta(key: str, name: str, a: int, b: int) -> str:
    us = ", ".join(S.u(key, f"{name}{i}") for i in range(a + b - 1))
    return f"list_sort([{us}])[{a}]"


def _normal(key: str, name: str) -> str:
    return (f"(sqrt(-2.0::double * ln(1.0::double - {S.u(key, name + 'a')})) "
            f"* cos({2 * math.pi!r}::double * {S.u(key, name + 'b')}))")


def _age(key: str) -> str:
    return f"cast(round({_beta(key, 'age', 2, 5)} * 62.0::double + 18.0::double) as int)"


def _amount(key: str, card: str, age: str) -> str:
    mult = " ".join(f"when {card} = '{c}' then {m!r}::double" for c, (_, m) in C.CARDS.items())
    return f"""cast(round(greatest(least(exp(4.5::double + ln(case {mult} else 1.0::double end)
      + ln(greatest(least(1.0::double + ({age} - 30) * 0.02::double, 2.0::double), 0.5::double))
      + 1.2::double * {_normal(key, 'amount')}), 50000000.0::double), 1000.0::double)) as bigint)"""


def _hour(key: str) -> str:
    small = f"{S.u(key, 'hour_of_day_small')} * 6.0::double"
    return f"""cast(greatest(least(round(case when {S.u(key, 'hour_of_day_off')} < 0.1::double
      then (case when {S.u(key, 'hour_of_day_late')} < 0.5::double then {small} else {small} + 22.0::double end)
      else {_beta(key, 'hour_of_day', 3, 2)} * 16.0::double + 6.0::double end), 23.0::double), 0.0::double) as int)"""


def _date(key: str) -> str:
    return f"cast(date '2024-01-01' + {S.scaled(S.u(key, 'date'), 0, 30)} as date)"


def _clock(key: str, hour: str) -> str:
    return (f"printf('%02d:%02d:%02d', {hour}, {S.scaled(S.u(key, 'minute'), 0, 59)}, "
            f"{S.scaled(S.u(key, 'second'), 0, 59)})")


@query("m1_assign_weighted", S.with_("users", f"""
select user_id, {S.pick(S.u('user_id', 'card_type'), CARDS, CARD_W)} as card_type,
  {S.pick(S.u('user_id', 'device_type'), DEVICES, DEVICE_W)} as device_type, city, province
from (select user_id, {S.pick(S.u('user_id', 'city'), S.CITY_VALUES, S.CITY_WEIGHTS)} as city from users)
join ({_DIM}) using (city)"""))
def assign_weighted(spark, d):
    ids = users(spark, d).select("user_id")
    return s.assign_location(s.assign_device(s.assign_card(ids, "user_id"), "user_id"), "user_id")


@query("m2_draw_beta_int", S.with_("users", f"select user_id, {_age('user_id')} as age from users"))
def draw_beta_int(spark, d):
    return s.draw_age(users(spark, d).select("user_id"), "user_id")


@query("m3_draw_lognormal", S.with_("users", f"""
select user_id, card_type, age, {_amount('user_id', 'card_type', 'age')} as amount
from (select user_id, age, {S.pick(S.u('user_id', 'card_type'), CARDS, CARD_W)} as card_type from users)"""))
def draw_lognormal(spark, d):
    ids = users(spark, d).select("user_id", "age")
    return s.draw_amount(s.assign_card(ids, "user_id"), "user_id").select(
        "user_id", "card_type", "age", "amount")


@query("m3_draw_lognormal_wide", """
select event_id, cast(round(greatest(least(exp(10.0::double + 1.2::double * NORMAL), 50000000.0::double),
  1000.0::double)) as bigint) as amount from events""".replace("NORMAL", _normal("event_id", "amount")))
def draw_lognormal_wide(spark, d):
    ids = spark.read.parquet(f"{d}/events.parquet").select("event_id")
    return s.draw_amount(ids, "event_id", card=None, age=None, mu=10.0)


_POISSON = " ".join(f"when uu < {b!r}::double then {k}" for k, b in enumerate(poisson_bounds(C.DAILY_RATE)))


@query("m4_draw_poisson", S.with_("users", f"""
select user_id, cast(case {_POISSON} else {len(poisson_bounds(C.DAILY_RATE))} end as int) as daily_count
from (select user_id, {S.u('user_id', 'daily_count')} as uu from users)"""))
def draw_poisson(spark, d):
    return s.draw_poisson(users(spark, d).select("user_id"), "user_id")


@query("m5_draw_hour", f"select event_id, {_hour('event_id')} as hour_of_day from events")
def draw_hour(spark, d):
    ids = spark.read.parquet(f"{d}/events.parquet").select("event_id")
    return s.draw_hour(ids, "event_id")


@query("m6_draw_date_time", f"""
select event_id, hour_of_day, {_date('event_id')} as transaction_date,
  {_clock('event_id', 'hour_of_day')} as transaction_time
from (select event_id, cast(hour(ts) as int) as hour_of_day from events)""")
def draw_date_time(spark, d):
    ids = spark.read.parquet(f"{d}/events.parquet").select(
        "event_id", F.hour("ts").alias("hour_of_day"))
    return s.draw_date_time(ids, "event_id")


def _kept(key: str) -> str:
    return f"""select {{cols}}, case when {S.u(key, 'keep_city')} < 0.8::double then t.city else drawn end as city,
  case when {S.u(key, 'keep_city')} < 0.8::double then t.province else dim.province end as province,
  case when {S.u(key, 'keep_card')} < 0.7::double then preferred_card_type
    else {S.pick(S.u(key, 'card_type'), CARDS, CARD_W)} end as card_type,
  case when {S.u(key, 'keep_device')} < 0.6::double then primary_device
    else {S.pick(S.u(key, 'device_type'), DEVICES, DEVICE_W)} end as device_type
from (select *, {S.pick(S.u(key, 'city'), S.CITY_VALUES, S.CITY_WEIGHTS)} as drawn from {{source}}) t
join ({_DIM}) dim on dim.city = t.drawn"""


@query("m7_keep_or_redraw", S.with_("users", _kept("user_id").format(cols="user_id", source="users")))
def keep_or_redraw(spark, d):
    return s.keep_or_redraw(users(spark, d), "user_id").select(
        "user_id", "city", "province", "card_type", "device_type")


_NOISY = """select transaction_id, user_id, round(amount, 4) as amount, transaction_date, transaction_time,
  province, city, card_type, device_type, is_weekend, hour_of_day, day_of_month, is_noise, noise_type from {t}"""


def _perturbed(spark, d, factor):
    rates = {k: v * factor for k, v in C.NOISE_RATES.items()}
    out = s.perturb_transactions(tx(spark, d), users(spark, d), rates)
    return out.withColumn("amount", F.round("amount", 4))


@query("m8_perturb_transactions", S.with_("tx users", _NOISY.format(t="ltx"), extra=S.labelled(1.0)))
def perturb(spark, d):
    return _perturbed(spark, d, 1.0)


@query("m8_perturb_transactions_tenfold", S.with_("tx users", _NOISY.format(t="ltx"), extra=S.labelled(10.0)))
def perturb_tenfold(spark, d):
    return _perturbed(spark, d, 10.0)


def _puser(key: str, column: str) -> str:
    city = S.pick(S.u(key, "p_city_v"), C.REMOTE_CITIES)
    return {
        "age": f"cast(case when {S.u(key, 'p_age')} < 0.01::double then {S.pick(S.u(key, 'p_age_v'), C.NOISY_AGES)} else age end as int)",
        "city": f"case when {S.u(key, 'p_city')} < 0.02::double then {city} else city end",
        "province": f"case when {S.u(key, 'p_city')} < 0.02::double then {S.case_in(city, C.SISTAN_CITIES, C.SISTAN, C.HORMOZGAN)} else province end",
    }[column]


_PUSERS = ", ".join(f"{_puser('user_id', c)} as {c}" for c in ("age", "province", "city"))


@query("m9_perturb_users", S.with_("users", f"""
select user_id, birth_year, registration_date, preferred_card_type, primary_device, {_PUSERS} from users"""))
def perturb_users(spark, d):
    return s.perturb_users(users(spark, d))


@query("m10_expand_rows", S.with_("users", f"""
select user_id, count(*) as cnt, cast(sum(hour_of_day) as bigint) as hours, cast(sum(amount) as bigint) as total,
  count(distinct city) as cities, count(distinct transaction_date) as days, max(transaction_time) as latest,
  cast(sum(is_weekend::int) as bigint) as weekend_rows
from (select user_id, row_key, {_hour('row_key')} as hour_of_day, city,
    {_amount('row_key', 'card_type', 'age')} as amount, {_date('row_key')} as transaction_date,
    isodow({_date('row_key')}) = 5 as is_weekend,
    {_clock('row_key', _hour('row_key'))} as transaction_time
  from ({_kept('row_key').format(cols='user_id, row_key, age', source='(select *, user_id || chr(47) || row_no as row_key from rows)')}))
group by user_id""", extra=f"""rows as (select *, unnest(range(1, {S.scaled(S.u('user_id', 'rows'), 2, 20)} + 1)) as row_no
  from users)"""))
def expand_rows(spark, d):
    out = s.synthesise_transactions(users(spark, d), 2, 20)
    return out.groupBy("user_id").agg(
        F.count("*").alias("cnt"), F.sum("hour_of_day").alias("hours"),
        F.sum(F.col("amount").cast("bigint")).alias("total"), F.count_distinct("city").alias("cities"),
        F.count_distinct("transaction_date").alias("days"), F.max("transaction_time").alias("latest"),
        F.count_if("is_weekend").alias("weekend_rows"))


@query("m12_user_attribute_columns", S.with_("users", f"""
select user_id, birth_year, registration_date, preferred_card_type, primary_device, {_PUSERS}
from (select *, cast(2024 - age as int) as birth_year from (
  select user_id, {_age('user_id')} as age,
    cast(date '2024-01-01' - {S.scaled(S.u('user_id', 'reg'), 180, 1824)} as date) as registration_date,
    {S.pick(S.u('user_id', 'city'), S.CITY_VALUES, S.CITY_WEIGHTS)} as city,
    {S.pick(S.u('user_id', 'preferred_card_type'), CARDS, CARD_W)} as preferred_card_type,
    {S.pick(S.u('user_id', 'primary_device'), DEVICES, DEVICE_W)} as primary_device from users)
  join ({_DIM}) using (city))"""))
def user_attributes(spark, d):
    return s.user_attributes(users(spark, d).select("user_id"))
