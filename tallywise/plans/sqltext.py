"""Building blocks of the SQL twins: common table expressions over the parquet tables."""

from __future__ import annotations

from fractions import Fraction
from itertools import accumulate

from .. import constants as C
from ..operators.synth import CITY_VALUES, CITY_WEIGHTS

__all__ = ["with_", "u", "pick", "case_in", "CITY_VALUES", "CITY_WEIGHTS", "round_cols"]


def lit(value) -> str:
    return f"'{value}'" if isinstance(value, str) else repr(value)


def u(key: str, salt: str) -> str:
    """Key uniform."""
    digest = f"md5(cast({key} as varchar) || ':{salt}')"
    return f"(cast('0x' || substr({digest}, 1, 8) as bigint) / 4294967296.0::double)"


def pick(unif: str, values: list, weights: list | None = None) -> str:
    exact = [Fraction(str(w)) for w in weights or [1] * len(values)]
    bounds = [float(upto / sum(exact)) for upto in accumulate(exact[:-1])]
    arms = " ".join(f"when {unif} < {b!r}::double then {lit(v)}" for b, v in zip(bounds, values))
    return f"(case {arms} else {lit(values[-1])} end)"


def case_in(column: str, values: list, then: str, other: str) -> str:
    return f"(case when {column} in ({', '.join(map(lit, values))}) then {lit(then)} else {lit(other)} end)"


def scaled(unif: str, low: int, high: int) -> str:
    return f"cast({low} + floor({unif} * {float(high - low + 1)!r}) as int)"


def device(n: str) -> str:
    return f"['android', 'ios', 'web', 'atm', 'pos'][cast({n} % 5 + 1 as int)]"


PLACES = """places as (
  select n_nationkey, r_name as province, n_name as city
  from nation join region on n_regionkey = r_regionkey)"""

USERS = f"""users as (
  select c_custkey as user_id, cast(18 + (c_custkey * 37) % 63 as int) as age,
    cast(2024 - (18 + (c_custkey * 37) % 63) as int) as birth_year,
    cast(date '2024-01-01' - cast(180 + (c_custkey * 131) % 1645 as int) as date) as registration_date,
    province, city, c_mktsegment as preferred_card_type, {device('c_custkey')} as primary_device
  from customer left join places on c_nationkey = n_nationkey)"""

TX = f"""tx as (
  select event_id as transaction_id, user_id, value as amount, cast(ts as date) as transaction_date,
    strftime(ts, '%H:%M:%S') as transaction_time, province, city, event_type as card_type,
    {device('k')} as device_type, isodow(ts) = 5 as is_weekend, cast(hour(ts) as int) as hour_of_day,
    cast(day(ts) as int) as day_of_month
  from (select *, cast(json_extract_string(props, '$.k') as int) as k from events)
  left join places on k % 25 = n_nationkey)"""


def labelled(factor: float = 2.0) -> str:
    rate = {k: repr(v * factor) + "::double" for k, v in C.NOISE_RATES.items()}
    key = "transaction_id"
    labels = C.NOISE_LABELS
    return f"""ltx as (
  select transaction_id, user_id, transaction_date, card_type, device_type, is_weekend, day_of_month,
    case when f_loc then {case_in('r_city', C.SISTAN_CITIES, C.SISTAN, C.HORMOZGAN)} else province end as province,
    case when f_loc then r_city else city end as city,
    case when f_age then 5e6 + {u(key, 'v_age')} * 1.5e7
      when f_amt then (case when {u(key, 'n_side')} < 0.7::double then 3e7 + {u(key, 'v_amt')} * 7e7
        else 100.0::double + {u(key, 'v_amt')} * 700.0::double end)
      else amount end as amount,
    case when f_time then r_hour else hour_of_day end as hour_of_day,
    case when f_time then lpad(cast(r_hour as varchar), 2, '0') || substr(transaction_time, 3)
      else transaction_time end as transaction_time,
    f_loc or f_age or f_time or f_amt as is_noise,
    nullif(concat_ws(',', case when f_loc then '{labels[0]}' end, case when f_age then '{labels[1]}' end,
      case when f_time then '{labels[2]}' end, case when f_amt then '{labels[3]}' end), '') as noise_type
  from (select *, (not f_age) and {u(key, 'n_amt')} < {rate['amount']} as f_amt from (
    select t.*, {u(key, 'n_loc')} < {rate['location']} as f_loc,
      coalesce(u.age, 30) < 25 and {u(key, 'n_age')} < {rate['age_amount']} as f_age,
      {u(key, 'n_time')} < {rate['time']} as f_time,
      {pick(u(key, 'v_city'), C.REMOTE_CITIES)} as r_city, {scaled(u(key, 'v_hour'), 2, 5)} as r_hour
    from tx t left join (select user_id, age from users) u using (user_id))))"""


LTX = labelled()


def features(source: str = "tx", name: str = "feats") -> str:
    """The 26-feature row per user."""
    return f"""{name}_ranked as (
  select *, row_number() over (partition by user_id order by amount) as rn,
    count(*) over (partition by user_id) as n from {source}),
{name}_base as (
  select user_id, count(*) as total_transactions, sum(amount) as total_amount,
    avg(amount) as avg_transaction_amount, coalesce(stddev_samp(amount), 0) as std_transaction_amount,
    min(amount) as min_transaction_amount, max(amount) as max_transaction_amount,
    median(amount) as median_transaction_amount,
    avg(hour_of_day) as avg_hour_of_day, coalesce(stddev_samp(hour_of_day), 0) as std_hour_of_day,
    avg(cast(is_weekend as int)) as weekend_transaction_ratio,
    avg(case when hour_of_day >= 22 or hour_of_day <= 6 then 1 else 0 end) as night_transaction_ratio,
    count(*)::double / count(distinct transaction_date) as transaction_frequency,
    count(distinct city) as unique_cities_count, count(distinct province) as unique_provinces_count,
    count(distinct city)::double / count(*) as geographical_diversity,
    count(distinct card_type)::double / count(*) as card_type_diversity,
    count(distinct device_type)::double / count(*) as device_type_diversity,
    max(case when rn = floor((n - 1) * 0.25 + 0.5) + 1 then amount end) as amount_percentile_25,
    max(case when rn = floor((n - 1) * 0.75 + 0.5) + 1 then amount end) as amount_percentile_75,
    case when min(amount) = max(amount) then 0.0 else
      (avg(amount ^ 3) - 3 * avg(amount) * avg(amount ^ 2) + 2 * avg(amount) ^ 3)
        / (var_pop(amount) ^ 1.5) end as amount_skewness
  from {name}_ranked group by user_id),
{name}_city as (
  select user_id, city from (select user_id, city, row_number() over (
    partition by user_id order by count(*) desc, city) as r from {source} group by user_id, city) where r = 1),
{name}_prov as (
  select user_id, province from (select user_id, province, row_number() over (
    partition by user_id order by count(*) desc, province) as r from {source} group by user_id, province) where r = 1),
{name}_reg as (
  select user_id, 1.0::double / (coalesce(stddev_samp(c), 0) + 1) as regularity_score
  from (select user_id, transaction_date, count(*) as c from {source} group by all) group by user_id),
{name} as (
  select u.user_id, coalesce(total_transactions, 0) as total_transactions,
    coalesce(total_amount, 0) as total_amount, coalesce(avg_transaction_amount, 0) as avg_transaction_amount,
    coalesce(std_transaction_amount, 0) as std_transaction_amount,
    coalesce(min_transaction_amount, 0) as min_transaction_amount,
    coalesce(max_transaction_amount, 0) as max_transaction_amount,
    coalesce(median_transaction_amount, 0) as median_transaction_amount,
    coalesce(avg_hour_of_day, 12.0::double) as avg_hour_of_day, coalesce(std_hour_of_day, 0) as std_hour_of_day,
    coalesce(weekend_transaction_ratio, 0) as weekend_transaction_ratio,
    coalesce(night_transaction_ratio, 0) as night_transaction_ratio,
    coalesce(transaction_frequency, 0) as transaction_frequency,
    coalesce(unique_cities_count, 0) as unique_cities_count,
    coalesce(unique_provinces_count, 0) as unique_provinces_count,
    coalesce(c.city, '{C.FALLBACK_CITY}') as most_frequent_city,
    coalesce(p.province, '{C.FALLBACK_CITY}') as most_frequent_province,
    coalesce(geographical_diversity, 0) as geographical_diversity,
    coalesce(card_type_diversity, 0) as card_type_diversity,
    coalesce(device_type_diversity, 0) as device_type_diversity,
    coalesce(regularity_score, 0) as regularity_score,
    coalesce(amount_percentile_25, 0) as amount_percentile_25,
    coalesce(amount_percentile_75, 0) as amount_percentile_75,
    coalesce(amount_percentile_75 - amount_percentile_25, 0) as amount_iqr,
    coalesce(amount_skewness, 0) as amount_skewness, u.age, u.birth_year
  from users u left join {name}_base using (user_id) left join {name}_city c using (user_id)
    left join {name}_prov p using (user_id) left join {name}_reg using (user_id))"""


PARTS = {"places": PLACES, "users": USERS, "tx": TX, "ltx": LTX, "feats": features(),
         "lfeats": features("ltx", "lfeats")}
NEEDS = {"places": [], "users": ["places"], "tx": ["places"], "ltx": ["tx", "users"],
         "feats": ["tx", "users"], "lfeats": ["ltx", "users"]}


def with_(names: str, body: str, extra: str = "") -> str:
    """`body` preceded by the named tables and what they need, then `extra` definitions."""
    order: list[str] = []

    def visit(n: str) -> None:
        for need in NEEDS[n]:
            visit(need)
        if n not in order:
            order.append(n)

    for n in names.split():
        visit(n)
    parts = [PARTS[n] for n in order] + ([extra] if extra else [])
    return ("with recursive " if "recursive_" in extra else "with ") + ",\n".join(parts) + "\n" + body


def round_cols(columns: list[str], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) as {c}" for c in columns)
