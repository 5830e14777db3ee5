"""DuckDB statements for the registered queries, written from the definitions and not from the Spark code.

Each statement is a chain of CTEs from the test tables to the result. Money is compared as double, dates and timestamps
as text, whole numbers as bigint.
"""

from __future__ import annotations

import re

from checks.raw_inputs import MOVED, ORDER_BASE, RAW_SQL, rename_tables

# ---- expression builders --------------------------------------------------------------------------------------------


def num(c: str, default: int | None = None) -> str:
    e = f"try_cast(try_cast({c} as decimal(38,0)) as bigint)"
    return f"{e} as {c}" if default is None else f"coalesce({e}, {default}) as {c}"


def money(c: str) -> str:
    return f"coalesce(try_cast({c} as decimal(38,2)), case when try_cast({c} as double) is null then 0 end) as {c}"


def dbl(c: str, default: str | None = None) -> str:
    e = f"try_cast({c} as double)"
    return f"{e} as {c}" if default is None else f"coalesce({e}, cast({default} as double)) as {c}"


def ts(c: str) -> str:
    return f"try_cast({c} as timestamp) as {c}"


def flag(c: str) -> str:
    return f"coalesce(upper(trim({c})) in ('Y', '1', 'TRUE'), false) as {c}"


def trimmed(c: str) -> str:
    return f"trim({c}) as {c}"


def blank_null(c: str, default: str | None = None) -> str:
    e = f"nullif(trim({c}), '')"
    return f"{e} as {c}" if default is None else f"coalesce({e}, '{default}') as {c}"


def digits(c: str) -> str:
    return f"regexp_replace({c}, '[^0-9]', '', 'g') as {c}"


def ratio(a: str, b: str) -> str:
    return f"(cast({a} as double) / nullif(cast({b} as double), 0))"


def avg(c: str) -> str:
    return ratio(f"sum({c})", f"count({c})")


def avg_d(c: str) -> str:
    # Through text, so that every digit of a double's shortest form counts; values that are not finite count as missing.
    kept = f"case when isfinite({c}) then {c} end"
    return ratio(f"sum(cast(cast({kept} as varchar) as decimal(38,18)))", f"count({kept})")


def rnd(e: str, n: int) -> str:
    return f"cast(round(cast(cast({e} as varchar) as decimal(38,18)), {n}) as double)"


def tally(cond: str) -> str:
    return f"cast(sum(case when {cond} then 1 else 0 end) as bigint)"


def total(c: str) -> str:
    return f"cast(sum({c}) as bigint)"


def gmv(c: str = "total_amount") -> str:
    return f"cast(sum({c}) as double)"


def retyped(body: str, *, dbls: str = "", text: str = "", ints: str = "") -> str:
    """The body with some columns cast to the types compared."""
    casts = [f"cast({c} as double) as {c}" for c in dbls.split()]
    casts += [f"cast({c} as varchar) as {c}" for c in text.split()]
    casts += [f"cast({c} as bigint) as {c}" for c in ints.split()]
    return f"select * replace ({', '.join(casts)}) from ({body}) t"


# ---- CTEs -----------------------------------------------------------------------------------------------------------

CTES: dict[str, str] = {"order_base": rename_tables(ORDER_BASE, str)}
for _name, _sql in RAW_SQL.items():
    CTES[f"raw_{_name}"] = rename_tables(_sql, str)

_STAGED: dict[str, list[str]] = {
    "customer": [
        num("customer_id"), trimmed("customer_name"), "lower(trim(email)) as email", digits("primary_phone"), ts("registered_at"),
        blank_null("city"), blank_null("area"), dbl("lat"), dbl("lng"), blank_null("segment", "New"), flag("is_prime_member"),
        blank_null("status", "ACTIVE"),
    ],
    "restaurant": [
        num("restaurant_id"), trimmed("restaurant_name"), trimmed("cuisine_primary"), trimmed("cuisine_secondary"),
        blank_null("city"), blank_null("area"), dbl("lat"), dbl("lng"), dbl("avg_rating", "0"), dbl("commission_rate", "0.2"),
        flag("is_active"), ts("onboarded_at"),
    ],
    "delivery_agent": [
        num("agent_id"), trimmed("agent_name"), digits("phone"), ts("hire_date"), blank_null("city"), trimmed("vehicle_type"),
        blank_null("status", "ACTIVE"),
    ],
    "menu_item": [
        num("menu_item_id"), num("restaurant_id"), trimmed("item_name"), trimmed("category"), money("price"), flag("is_veg"),
        flag("is_active"),
    ],
    "promotion": [
        num("promo_id"), trimmed("promo_code"), money("discount_percent"), ts("start_date"), ts("end_date"),
        money("max_discount_amt"), trimmed("target_segment"), trimmed("target_city"),
    ],
    "order_header": [
        num("order_id"), num("customer_id"), num("restaurant_id"), ts("order_created_at"),
        "upper(trim(order_status)) as order_status", "upper(trim(payment_method)) as payment_method", num("promo_id"),
        money("order_subtotal"), money("order_discount"), money("delivery_fee"), money("total_amount"),
        ts("expected_delivery_at"), ts("actual_delivery_at"), blank_null("cancellation_reason"),
    ],
    "order_item": [
        num("order_id"), num("order_item_id"), num("menu_item_id"), num("qty", 0), money("item_price"), money("item_discount"),
        money("total_item_amount"),
    ],
    "delivery_trip": [
        num("trip_id"), num("order_id"), num("agent_id"), ts("pickup_time"), ts("drop_time"), dbl("distance_km", "0"),
        num("estimated_time_min", 0), num("actual_time_min", 0), num("sla_breach_flag", 0),
    ],
    "payment": [
        num("payment_id"), num("order_id"), "upper(trim(payment_status)) as payment_status", ts("payment_at"), money("payment_amount"),
    ],
    "feedback": [
        num("feedback_id"), num("order_id"), num("customer_id"), num("rating", 0), "comment", dbl("sentiment_score"), ts("created_at"),
    ],
}
_RAW_OF = {"feedback": "customer_feedback"}
for _name, _exprs in _STAGED.items():
    CTES[f"stg_{_name}"] = f"select {', '.join(_exprs)} from raw_{_RAW_OF.get(_name, _name)}"


def _staged_from(name: str, source: str) -> str:
    return f"select {', '.join(_STAGED[name])} from {source}"


def _json(path: str) -> str:
    return f"json_extract_string(event_raw, '$.{path}')"


CTES["stg_customer_events"] = f"""
select cast({_json('event_id')} as bigint) as event_id, cast({_json('customer_id')} as bigint) as customer_id,
 {_json('event_type')} as event_type, try_cast({_json('event_ts')} as timestamp) as event_ts,
 {_json('metadata.search_query')} as search_query, {_json('metadata.device_os')} as device_os,
 {_json('metadata.app_version')} as app_version
from raw_customer_events
"""


def _calendar(first: str, last: str) -> str:
    return f"""
select cast(strftime(d, '%Y%m%d') as bigint) as date_key, cast(d as date) as full_date, cast(year(d) as bigint) as year,
 cast(month(d) as bigint) as month, strftime(d, '%b') as month_short, cast(day(d) as bigint) as day_of_month,
 cast(dayofweek(d) as bigint) as day_of_week, strftime(d, '%a') as day_of_week_short, cast(weekofyear(d) as bigint) as week_of_year
from (select unnest(generate_series({first}, {last}, interval 1 day)) as d)
"""


CTES["dates"] = _calendar("timestamp '1995-01-01'", "timestamp '2028-12-31'")
CTES["order_dates"] = _calendar(
    "(select cast(cast(min(o_orderdate) as date) as timestamp) from orders)",
    "(select cast(cast(max(o_orderdate) as date) as timestamp) from orders)",
)

CTES["rates"] = "select restaurant_id as place, cast(cast(commission_rate as varchar) as decimal(25,18)) as share from stg_restaurant"
CTES["late_trips"] = "select order_id as trip_order, sla_breach_flag = 1 as late from stg_delivery_trip"
CTES["priced"] = """
select o.*, cast(total_amount as decimal(12,2)) as due, cast(total_amount as decimal(12,2)) * share as cut, coalesce(late, false) as late
from stg_order_header o left join rates on place = o.restaurant_id left join late_trips on trip_order = o.order_id
"""
CTES["fct_order"] = """
select order_id, customer_id, restaurant_id, date_key as order_date_key, order_status, payment_method, promo_id, order_subtotal,
 order_discount, delivery_fee, total_amount, order_subtotal - order_discount as net_food_amount,
 case when order_subtotal > 0 then cast(order_discount as double) / cast(order_subtotal as double) else 0 end as discount_pct,
 cast(late as bigint) as sla_breached, cast(cut as decimal(12,2)) as platform_commission,
 cast(due - cut as decimal(12,2)) as restaurant_payout, date_diff('minute', order_created_at, actual_delivery_at) as end_to_end_min,
 cast(order_status = 'DELIVERED' as bigint) as is_delivered, cast(order_status = 'CANCELLED' as bigint) as is_cancelled
from priced left join dates on full_date = cast(order_created_at as date)
"""

CTES["fct_delivery"] = "select * replace (cast(distance_km as decimal(10,2)) as distance_km) from stg_delivery_trip"

CTES["enriched"] = """
select f.order_id, f.order_date_key, dd.full_date, f.total_amount, f.order_subtotal, f.order_discount, f.delivery_fee, f.net_food_amount,
 f.discount_pct, f.sla_breached, f.platform_commission, f.restaurant_payout, f.end_to_end_min, f.order_status, f.payment_method,
 f.promo_id, f.is_delivered, f.is_cancelled, c.customer_id, c.customer_name, c.city as customer_city, c.area as customer_area,
 c.segment as customer_segment, r.restaurant_id, r.restaurant_name, r.city as restaurant_city, r.area as restaurant_area,
 r.cuisine_primary, r.commission_rate, t.distance_km, t.sla_breach_flag, fb.rating, fb.sentiment_score
from fct_order f left join dates dd on f.order_date_key = dd.date_key left join stg_customer c on f.customer_id = c.customer_id
 left join stg_restaurant r on f.restaurant_id = r.restaurant_id left join fct_delivery t on f.order_id = t.order_id
 left join stg_feedback fb on f.order_id = fb.order_id
"""

_DAY = "restaurant_id, restaurant_name, restaurant_city, cuisine_primary"
_PERSON = "customer_id, customer_name, customer_city, customer_area, customer_segment"
_LOW = "rating is not null and rating <= 3"

CTES["rest_daily"] = f"""
select {_DAY}, full_date, sum(total_amount) as gmv, {total('is_delivered')} as delivered_orders,
 {total('is_cancelled')} as cancelled_orders, sum(restaurant_payout) as restaurant_payout,
 sum(platform_commission) as platform_commission, {avg('sla_breached')} as sla_breach_rate, {avg('rating')} as avg_rating,
 {avg('end_to_end_min')} as avg_delivery_time_min
from enriched group by all
"""
CTES["rest_rolling"] = """
select *, sum(gmv) over (w rows between 6 preceding and current row) as gmv_7d,
 sum(gmv) over (w rows between 29 preceding and current row) as gmv_30d
from rest_daily window w as (partition by restaurant_id order by full_date asc nulls last)
"""
CTES["rest_lagged"] = """
select *, lag(gmv_7d, 7) over (partition by restaurant_id order by full_date asc nulls last) as gmv_7d_prev from rest_rolling
"""

CTES["agent_kpi"] = f"""
select a.agent_id, a.agent_name, a.city as agent_city, count(distinct d.order_id) as orders_delivered,
 {avg('d.distance_km')} as avg_distance_per_order, {avg('d.actual_time_min')} as avg_delivery_time_min,
 {avg('d.sla_breach_flag')} as sla_breach_rate, count(distinct cast(d.pickup_time as date)) as days_worked,
 {ratio('count(distinct d.order_id)', 'count(distinct cast(d.pickup_time as date))')} as avg_orders_per_day
from fct_delivery d join stg_delivery_agent a on d.agent_id = a.agent_id group by a.agent_id, a.agent_name, a.city
"""

CTES["searches"] = """
select customer_id, cast(event_ts as date) as dt, count(*) as n from stg_customer_events where event_type = 'SEARCH' group by 1, 2
"""
CTES["buys"] = "select customer_id, full_date as dt, count(*) as n from raw_purchase where is_delivered = 1 group by 1, 2"
CTES["funnel"] = f"""
select c.city as customer_city, s.dt, {total('s.n')} as total_searches, {total('o.n')} as total_orders,
 {ratio('sum(o.n)', 'sum(s.n)')} as search_to_order_ratio
from searches s join buys o on s.customer_id = o.customer_id and s.dt = o.dt join stg_customer c on s.customer_id = c.customer_id
group by 1, 2
"""

CTES["city_daily"] = f"""
select full_date, customer_city, restaurant_city, count(*) as total_orders, {gmv()} as gmv, {total('is_delivered')} as delivered_orders,
 {total('is_cancelled')} as cancelled_orders, {rnd(avg('rating'), 2)} as avg_rating,
 {rnd(avg_d('sentiment_score'), 2)} as avg_sentiment_score, {rnd(avg('sla_breach_flag'), 4)} as avg_sla_breach_rate
from enriched group by 1, 2, 3
"""

# Orders with a negative id or none at all, as the stream gets them: those without one have no trip and no feedback.
_ODD = "case when order_id % 50 = 7 then -order_id when order_id % 50 <> 9 then order_id end"
CTES["enriched_plain"] = """
select f.order_id, f.is_delivered, f.is_cancelled, f.total_amount, dd.full_date, c.city as customer_city, r.city as restaurant_city
from fct_order f left join dates dd on f.order_date_key = dd.date_key left join stg_customer c on f.customer_id = c.customer_id
 left join stg_restaurant r on f.restaurant_id = r.restaurant_id
"""
CTES["odd_orders"] = f"select * replace ({_ODD} as order_id) from enriched_plain"
CTES["odd_trips"] = f"select {_ODD} as trip_of, sla_breach_flag from stg_delivery_trip"
CTES["odd_feedback"] = f"select {_ODD} as rated, feedback_id, rating, sentiment_score from stg_feedback"
for _name, _value in {"odd_all": "rating", "odd_lowered": "case when feedback_id % 10 = 3 then 1 else rating end"}.items():
    CTES[_name] = f"""
select o.*, t.sla_breach_flag, {_value} as rating, sentiment_score
from odd_orders o left join odd_trips t on trip_of = o.order_id left join odd_feedback f on rated = o.order_id
"""


def _city_days(source: str) -> str:
    return f"""
select full_date, customer_city, restaurant_city, count(*) as total_orders, {gmv()} as gmv, {total('is_delivered')} as delivered_orders,
 {total('is_cancelled')} as cancelled_orders, {rnd(avg('rating'), 2)} as avg_rating,
 {rnd(avg_d('sentiment_score'), 2)} as avg_sentiment_score, {rnd(avg('sla_breach_flag'), 4)} as avg_sla_breach_rate
from {source} group by 1, 2, 3
"""


CTES["rest_feedback"] = f"""
select {_DAY}, count(*) as total_orders, {total('is_delivered')} as delivered_orders, {total('is_cancelled')} as cancelled_orders,
 coalesce({ratio('sum(is_cancelled)', 'count(*)')}, 0) as cancel_rate, {avg('rating')} as avg_customer_rating,
 {avg_d('sentiment_score')} as avg_sentiment_score, {tally(_LOW)} as low_rating_orders,
 {ratio(tally(_LOW + ' and is_delivered = 1'), 'sum(is_delivered)')} as low_rating_delivered_pct,
 {avg('end_to_end_min')} as avg_end_to_end_min, {avg('distance_km')} as avg_distance_km, {avg('sla_breach_flag')} as sla_breach_rate
from enriched group by all
"""

CTES["role_access"] = """
select * from (values ('CITY_A', 'CITY', 'NATION_0', null), ('CITY_B', 'CITY', 'NATION_1', null),
 ('REST_3', 'RESTAURANT', null, 3), ('REST_7', 'RESTAURANT', null, 7)) v(role_name, access_type, city, restaurant_id)
"""


def _visible(role: str) -> str:
    return f"""
select e.* from enriched e where '{role}' in ('ADMIN', 'SYSADMIN') or exists (
 select 1 from role_access r where r.role_name = '{role}' and ((r.access_type = 'CITY' and r.city = e.restaurant_city)
  or (r.access_type = 'RESTAURANT' and r.restaurant_id = e.restaurant_id)))
"""


def _query(body: str) -> str:
    """The body, headed by the CTEs it needs, in order of definition."""

    def names(sql: str) -> set[str]:
        return set(re.findall(r"\b[a-z_][a-z_0-9]*\b", re.sub(r"'[^']*'", "", sql))) & CTES.keys()

    needed, todo = set(), names(body)
    while todo:
        needed |= todo
        todo = set().union(*[names(CTES[n]) for n in todo]) - needed
    head = ",\n".join(f"{n} as ({sql.strip()})" for n, sql in CTES.items() if n in needed)
    body = body.strip()
    if head and body.startswith("with "):
        return f"with {head},\n{body[5:]}"
    return f"with {head}\n{body}" if head else body


# ---- dimensions over two deliveries ---------------------------------------------------------------------------------

_T1, _T2, _OPEN = "2024-06-01 00:00:00", "2024-06-02 00:00:00", "9999-12-31 00:00:00"

for _name, (_key, _changes) in MOVED.items():
    CTES[f"first_{_name}"] = f"select * from raw_{_name} where not ends_with({_key}, '9')"
    _set = ", ".join(f"case when ends_with({_key}, '5') then {v} else {c} end as {c}" for c, v in _changes.items())
    CTES[f"second_{_name}"] = f"select * replace ({_set}) from raw_{_name}"
    CTES[f"stg_first_{_name}"] = _staged_from(_name, f"first_{_name}")
    CTES[f"stg_second_{_name}"] = _staged_from(_name, f"second_{_name}")


def _scd2(name: str, key: str, compared: dict[str, str], carried: str = "") -> str:
    """Versions after two deliveries: a key whose compared values differ, NULL being its default, closes one and opens another."""
    cols = ", ".join([key, *compared, *carried.split()])
    differs = " or ".join(f"coalesce(a.{c}, {d}) <> coalesce(b.{c}, {d})" for c, d in compared.items())
    CTES[f"changed_{name}"] = f"""
select a.{key} as moved from stg_first_{name} a join stg_second_{name} b on a.{key} = b.{key} where {differs}
"""
    return f"""
select {cols}, '{_T1}' as effective_from, case when moved is null then '{_OPEN}' else '{_T2}' end as effective_to,
 moved is null as is_current, 'stg_{name}' as record_source, true as key_is_unique, true as key_has_grown
from stg_first_{name} left join changed_{name} on moved = {key} where {key} is not null
union all
select {cols}, '{_T2}', '{_OPEN}', true, 'stg_{name}', true, true from stg_second_{name}
where {key} is not null and ({key} in (select moved from changed_{name}) or {key} not in (select {key} from stg_first_{name} where {key} is not null))
"""


_CUSTOMER_SCD2 = _scd2(
    "customer",
    "customer_id",
    {c: "''" for c in "customer_name email primary_phone city area segment status".split()} | {"is_prime_member": "false"},
)
_RESTAURANT_SCD2 = _scd2(
    "restaurant",
    "restaurant_id",
    {c: "''" for c in "restaurant_name cuisine_primary cuisine_secondary city area".split()}
    | {"avg_rating": "0", "commission_rate": "0", "is_active": "false"},
    "onboarded_at",
)

# ---- one statement per registered query -----------------------------------------------------------------------------

_ENRICHED_TYPES = dict(
    dbls="total_amount order_subtotal order_discount delivery_fee net_food_amount platform_commission restaurant_payout distance_km",
    text="full_date",
)
_RANGE = "full_date between date '1996-01-01' and date '1999-06-30'"
_SOME = f"{_RANGE} and restaurant_city in ('NATION_1', 'NATION_2', 'NATION_7') and cuisine_primary in ('Chinese', 'Italian', 'Bakery')"

_RATING = f"{rnd(avg('rating'), 2)} as avg_rating"
_SENTIMENT = f"{rnd(avg_d('sentiment_score'), 2)} as avg_sentiment_score"
_CANCEL = f"{rnd(ratio('sum(is_cancelled)', 'count(*)'), 4)} as cancel_rate"
_DONE = f"{total('is_delivered')} as delivered_orders"
_GONE = f"{total('is_cancelled')} as cancelled_orders"

_REST_TABLE = f"""
select {_DAY}, {gmv()} as gmv, {_DONE}, {_GONE}, {avg('rating')} as avg_rating, {avg('end_to_end_min')} as avg_delivery_time_min
from enriched where {{where}} group by all
"""
_REST_TIES = "restaurant_id nulls last, restaurant_name nulls last, restaurant_city nulls last, cuisine_primary nulls last"

BODIES: dict[str, str] = {
    "ingest_null_tokens": "select "
    + ", ".join(
        f"case when {c} in ('', 'NULL', 'null') then null else {c} end as {c}"
        for c in "order_id customer_id restaurant_id order_created_at order_status payment_method promo_id order_subtotal order_discount"
        " delivery_fee total_amount expected_delivery_at actual_delivery_at cancellation_reason".split()
    )
    + " from raw_order_header",
    "ingest_stream_events": retyped("select * from stg_customer_events", text="event_ts"),
    "update_where": """
select agent_id, agent_name, phone, hire_date, case when right(agent_id, 1) = '1' then 'Moved' else city end as city, vehicle_type,
 case when right(agent_id, 1) = '1' then 'INACTIVE' else status end as status from raw_delivery_agent
""",
    "ingest_events_batch": retyped("select * from stg_customer_events", text="event_ts"),
    "ingest_csv_feedback": retyped(
        "select * replace ('said \"' || comment || '\",' || chr(10) || 'then left' as comment) from stg_feedback", text="created_at"
    ),
    "events_latest": retyped(
        "select * replace (case when event_id % 2 = 1 and device_os = 'iOS' then 'Old' else device_os end as device_os) from stg_customer_events",
        text="event_ts",
    ),
    "table_overwrite": "select agent_id, upper(city) as city from stg_delivery_agent",
    "table_append": "select trip_id, order_id from stg_delivery_trip",
    "run_log": f"""
select unnest(['dim_date', 'dim_customer', 'dim_restaurant', 'dim_restaurant_scd3', 'dim_delivery_agent', 'dim_promotion',
 'fct_order_enhanced', 'fct_delivery', 'fct_feedback', 'fct_customer_event', 'fct_order_secure']) as proc_name, '{_T1}' as run_ts,
 'SUCCESS' as status
""",
    "stg_money_wide": f"""
select {num('order_id')}, cast(case when ends_with(order_id, '3') then 0
 else cast('98765432109876543210' || lpad(order_id, 10, '0') || '.129' as decimal(38,2)) end as varchar) as amount from raw_order_header
""",
    "dirty_sentiment_kpi": """
with scored as (
 select rating, feedback_id % 7 as kind,
  case feedback_id % 7 when 0 then null when 1 then null when 2 then 1e13 when 3 then 0.123456789::double else sentiment_score end as score
 from stg_feedback)
select rating, kind, (coalesce(cast(sum(cast(cast(case when abs(score) < 1e9 then score end as varchar) as decimal(38,18))) as double), 0)
 + coalesce(sum(case when abs(score) >= 1e9 then score end), 0)) / nullif(count(score), 0) as avg_sentiment, count(*) as n
from scored group by 1, 2
""",
    "commission_long_rate": """
with cut as (
 select order_id, total_amount as due, total_amount * case restaurant_id % 3 when 0 then cast('0.123456789123' as decimal(25,18))
  when 1 then cast('1234.5' as decimal(25,18)) else share end as part
 from (select o.order_id, cast(o.total_amount as decimal(12,2)) as total_amount, r.restaurant_id, share
  from stg_order_header o left join stg_restaurant r on r.restaurant_id = o.restaurant_id left join rates on place = o.restaurant_id) t)
select order_id, cast(cast(part as decimal(12,2)) as double) as platform_commission,
 cast(cast(due - part as decimal(12,2)) as double) as restaurant_payout from cut
""",
    "city_search_to_order_enriched": retyped(
        f"""
with first_day as (select customer_id, min(full_date) as dt from enriched where is_delivered = 1 group by 1),
 looked as (select e.customer_id, f.dt, count(*) as n from stg_customer_events e join first_day f on e.customer_id = f.customer_id
  where event_type = 'SEARCH' group by 1, 2),
 bought as (select customer_id, full_date as dt, count(*) as n from enriched where is_delivered = 1 group by 1, 2)
select c.city as customer_city, s.dt, {total('s.n')} as total_searches, {total('o.n')} as total_orders,
 {ratio('sum(o.n)', 'sum(s.n)')} as search_to_order_ratio
from looked s join bought o on s.customer_id = o.customer_id and s.dt = o.dt join stg_customer c on s.customer_id = c.customer_id group by 1, 2
""",
        text="dt",
    ),
    "flag_normalise": f"select {num('customer_id')}, is_prime_member as raw_flag, {flag('is_prime_member')} from raw_customer",
    "stg_customer": retyped("select * from stg_customer", text="registered_at"),
    "stg_restaurant": retyped("select * from stg_restaurant", text="onboarded_at"),
    "stg_delivery_agent": retyped("select * from stg_delivery_agent", text="hire_date"),
    "stg_menu_item": retyped("select * from stg_menu_item", dbls="price"),
    "stg_promotion": retyped("select * from stg_promotion", dbls="discount_percent max_discount_amt", text="start_date end_date"),
    "stg_order_header": retyped(
        "select * from stg_order_header",
        dbls="order_subtotal order_discount delivery_fee total_amount",
        text="order_created_at expected_delivery_at actual_delivery_at",
    ),
    "stg_order_item": retyped("select * from stg_order_item", dbls="item_price item_discount total_item_amount"),
    "stg_delivery_trip": retyped("select * from stg_delivery_trip", text="pickup_time drop_time"),
    "stg_payment": retyped("select * from stg_payment", dbls="payment_amount", text="payment_at"),
    "stg_feedback": retyped("select * from stg_feedback", text="created_at"),
    "stg_customer_events": retyped("select * from stg_customer_events", text="event_ts"),
    "dim_date": retyped("select * from order_dates", text="full_date"),
    "scd2_customer": _CUSTOMER_SCD2,
    "scd2_restaurant": retyped(_RESTAURANT_SCD2, text="onboarded_at"),
    "scd2_history": f"""
select customer_id, customer_name, city, segment, effective_from, effective_to, is_current
from ({_CUSTOMER_SCD2}) v
""",
    "scd3_restaurant_cuisine": f"""
select restaurant_id, restaurant_name, cuisine_primary as current_cuisine, cast(null as varchar) as previous_cuisine,
 case when restaurant_id % 10 = 9 then '{_T2}' else '{_T1}' end as last_change_date, city, area
from stg_restaurant where restaurant_id % 10 <> 5
union all
select a.restaurant_id, a.restaurant_name, b.cuisine_primary, a.cuisine_primary, '{_T2}', b.city, b.area
from stg_restaurant a join stg_second_restaurant b on a.restaurant_id = b.restaurant_id where a.restaurant_id % 10 = 5
""",
    "scd1_delivery_agent": retyped("select * from stg_second_delivery_agent", text="hire_date"),
    "scd1_promotion": retyped(
        "select * from stg_second_promotion", dbls="discount_percent max_discount_amt", text="start_date end_date"
    ),
    "fct_order_enhanced": retyped(
        "select * from fct_order",
        dbls="order_subtotal order_discount delivery_fee total_amount net_food_amount platform_commission restaurant_payout",
    ),
    "fct_delivery": retyped("select * from fct_delivery", dbls="distance_km", text="pickup_time drop_time"),
    "fct_feedback": retyped("select * from stg_feedback", text="created_at"),
    "fct_customer_event": retyped("select * from stg_customer_events", text="event_ts"),
    # After two deliveries, refreshed by change, the tables are what one full refresh makes of the last versions.
    "refresh_incremental": retyped("select * from enriched", **_ENRICHED_TYPES),
    "refresh_incremental_trips": retyped("select * from fct_delivery", dbls="distance_km", text="pickup_time drop_time"),
    "refresh_incremental_feedback": retyped("select * from stg_feedback", text="created_at"),
    "refresh_incremental_events": retyped("select * from stg_customer_events", text="event_ts"),
    "refresh_incremental_promotions": retyped(
        "select * from stg_promotion", dbls="discount_percent max_discount_amt", text="start_date end_date"
    ),
    "mask_email": r"""
select customer_id, regexp_replace(email, '(^.).*(@.*$)', '\1*****\2') as email, email as email_clear from stg_customer
""",
    "mask_phone": """
select customer_id, 'XXXXXX' || right(primary_phone, 4) as primary_phone, primary_phone as primary_phone_clear from stg_customer
""",
    "masked_customers": r"""
select customer_id, customer_name, regexp_replace(email, '(^.).*(@.*$)', '\1*****\2') as email,
 'XXXXXX' || right(primary_phone, 4) as primary_phone, city, area, segment, is_prime_member, status from stg_customer
""",
    "sla_bucket": """
select o.order_id, t.estimated_time_min, t.actual_time_min,
 case when t.actual_time_min is null then 'UNKNOWN' when t.actual_time_min <= t.estimated_time_min then 'ON_TIME'
  when t.actual_time_min <= t.estimated_time_min + 10 then 'SLIGHT_DELAY' else 'HEAVY_DELAY' end as bucket
from stg_order_header o left join fct_delivery t on o.order_id = t.order_id
""",
    "fct_order_secure": retyped("select * from enriched", **_ENRICHED_TYPES),
    "order_enriched": retyped("select * from enriched", **_ENRICHED_TYPES),
    "restaurant_advanced_kpi": retyped(
        f"select *, {ratio('gmv_7d - gmv_7d_prev', 'gmv_7d_prev')} as gmv_7d_wow_growth from rest_lagged",
        dbls="gmv restaurant_payout platform_commission gmv_7d gmv_30d gmv_7d_prev",
        text="full_date",
    ),
    "agent_efficiency_kpi": "select * from agent_kpi",
    "city_search_to_order": retyped("select * from funnel", text="dt"),
    "restaurant_feedback_kpi": "select * from rest_feedback",
    "customer_experience_kpi": retyped(
        f"""
select {_PERSON}, count(*) as total_orders, {_DONE}, {_GONE}, {avg('total_amount')} as avg_order_value, {avg('rating')} as avg_rating,
 {avg_d('sentiment_score')} as avg_sentiment_score, {tally(_LOW)} as low_rating_orders, min(full_date) as first_order_date,
 max(full_date) as last_order_date, date_diff('day', max(full_date), date '2024-06-01') as days_since_last_order
from enriched group by all
""",
        text="first_order_date last_order_date",
    ),
    "agent_feedback_kpi": f"""
select a.agent_id, a.agent_name, a.city as agent_city, a.vehicle_type, a.status as agent_status,
 count(distinct d.order_id) as orders_delivered, {avg('d.distance_km')} as avg_distance_km,
 {avg('d.actual_time_min')} as avg_delivery_time_min, {avg('d.sla_breach_flag')} as sla_breach_rate,
 {avg('o.rating')} as avg_customer_rating, {avg_d('o.sentiment_score')} as avg_sentiment_score,
 {tally('o.rating is not null and o.rating <= 3')} as low_rating_orders,
 count(distinct cast(d.pickup_time as date)) as days_worked,
 {ratio('count(distinct d.order_id)', 'count(distinct cast(d.pickup_time as date))')} as avg_orders_per_day
from fct_delivery d join stg_delivery_agent a on d.agent_id = a.agent_id left join enriched o on d.order_id = o.order_id
group by 1, 2, 3, 4, 5
""",
    "daily_city_kpi": retyped("select * from city_daily", text="full_date"),
    "daily_city_kpi_stream": retyped(_city_days("odd_all"), text="full_date"),
    "daily_city_late_feedback": retyped(_city_days("odd_lowered"), text="full_date"),
    "q1_city_kpi": f"""
select restaurant_city as city, count(*) as total_orders, {gmv()} as gmv, {_DONE}, {_GONE}, {_RATING}, {_SENTIMENT},
 {rnd(avg('sla_breach_flag'), 4)} as avg_sla_breach_rate from enriched group by 1
""",
    "q2_top_restaurants": f"""
select {_DAY}, count(*) as total_orders, {gmv()} as gmv, {rnd(avg('end_to_end_min'), 2)} as avg_end_to_end_min,
 {rnd(avg('sla_breach_flag'), 4)} as sla_breach_rate, {_RATING}
from enriched group by all order by sum(total_amount) desc nulls first, {_REST_TIES} limit 15
""",
    "q3_problem_restaurants": f"""
select * from (
 select {_DAY}, count(*) as total_orders, {_RATING}, {_SENTIMENT}, {_CANCEL}, {rnd(avg('sla_breach_flag'), 4)} as sla_breach_rate
 from enriched group by all having count(*) >= 5)
order by avg_rating asc nulls last, cancel_rate desc nulls first, sla_breach_rate desc nulls first, {_REST_TIES} limit 20
""",
    "q4_cuisine_city": f"""
select restaurant_city, cuisine_primary, count(*) as total_orders, {gmv()} as gmv, {_RATING}, {_SENTIMENT} from enriched group by 1, 2
""",
    "q5_segment_kpi": f"""
select customer_segment, count(*) as total_orders, count(distinct customer_id) as unique_customers, {gmv()} as gmv,
 {rnd(avg('total_amount'), 2)} as avg_order_value, {_RATING}, {_SENTIMENT}, {_CANCEL} from enriched group by 1
""",
    "q6_prime_kpi": f"""
select coalesce(c.is_prime_member, false) as is_prime_member, count(*) as total_orders,
 count(distinct e.customer_id) as unique_customers, {gmv()} as gmv, {rnd(avg('total_amount'), 2)} as avg_order_value, {_RATING}, {_SENTIMENT}
from enriched e left join stg_customer c on e.customer_id = c.customer_id group by 1
""",
    "q7_agent_perf": f"""
select a.agent_id, a.agent_name, a.city as agent_city, a.vehicle_type, a.status as agent_status,
 count(distinct d.order_id) as orders_delivered, {rnd(avg('d.distance_km'), 2)} as avg_distance_km,
 {rnd(avg('d.actual_time_min'), 2)} as avg_delivery_time_min, {rnd(avg('d.sla_breach_flag'), 4)} as sla_breach_rate
from fct_delivery d join stg_delivery_agent a on d.agent_id = a.agent_id group by 1, 2, 3, 4, 5
""",
    "q8_feedback_dist": f"""
select o.restaurant_city, f.rating, count(*) as feedback_count, {rnd(avg_d('f.sentiment_score'), 2)} as avg_sentiment_score
from stg_feedback f left join enriched o on f.order_id = o.order_id group by 1, 2
""",
    "q9_commission_city": f"""
select restaurant_city as city, {gmv()} as gmv, {gmv('platform_commission')} as total_platform_commission,
 {gmv('restaurant_payout')} as total_restaurant_payout,
 {rnd(ratio('sum(platform_commission)', 'sum(total_amount)'), 4)} as effective_commission_pct from enriched group by 1
""",
    "secure_order_counts": "select restaurant_city, restaurant_id, count(*) as order_cnt from enriched group by 1, 2",
    "dash_date_bounds": "select cast(min(full_date) as varchar) as min_date, cast(max(full_date) as varchar) as max_date from enriched",
    "dash_cities": "select distinct restaurant_city from enriched where restaurant_city is not null",
    "dash_cuisines": "select distinct cuisine_primary from enriched where cuisine_primary is not null",
    "dash_filtered": retyped(f"select * from enriched where {_SOME}", **_ENRICHED_TYPES),
    "dash_overview": f"""
select coalesce({gmv()}, 0) as gmv, coalesce({total('is_delivered')}, 0) as delivered_orders,
 coalesce({total('is_cancelled')}, 0) as cancelled_orders, coalesce({avg('rating')}, 0) as avg_rating,
 coalesce({avg('end_to_end_min')}, 0) as avg_delivery_time_min, coalesce({avg('sla_breached')}, 0) as sla_breach_rate,
 coalesce({ratio('sum(is_cancelled)', 'sum(is_delivered) + sum(is_cancelled)')} * 100, 0) as cancellation_pct
from enriched where {_SOME}
""",
    "dash_daily": retyped(
        f"select full_date, {gmv()} as gmv, {_DONE} from enriched where {_SOME} group by 1", text="full_date"
    ),
    "dash_restaurants": _REST_TABLE.format(where=_RANGE),
    "dash_top15_restaurants": f"select * from ({_REST_TABLE.format(where=_RANGE)}) order by gmv desc nulls first, {_REST_TIES} limit 15",
    "dash_cuisine_kpi": f"""
select cuisine_primary, {gmv()} as gmv, {_DONE}, {avg('rating')} as avg_rating from enriched where {_RANGE} group by 1
""",
    "dash_city_funnel": retyped(
        "select * from funnel where dt between date '2024-01-05' and date '2024-01-20'", text="dt"
    ),
    "dash_agents": "select * exclude (days_worked) from agent_kpi",
    "dash_top10_agents": "select * exclude (days_worked) from agent_kpi order by orders_delivered desc, agent_id limit 10",
    "dash_order_detail": retyped(
        f"""
select full_date, order_id, restaurant_name, restaurant_city, cuisine_primary, customer_name, customer_city, total_amount, order_status,
 payment_method, rating, sentiment_score, end_to_end_min from enriched where {_SOME}
""",
        dbls="total_amount",
        text="full_date",
    ),
    "dash_explore": "select * from rest_feedback where restaurant_city in ('NATION_1', 'NATION_2', 'NATION_7')"
    " and cuisine_primary in ('Chinese', 'Italian', 'Bakery')",
}
for _key, _role in {"rls_city": "CITY_A", "rls_restaurant": "REST_3", "rls_unmapped": "NOBODY", "rls_admin": "ADMIN"}.items():
    BODIES[_key] = retyped(_visible(_role), **_ENRICHED_TYPES)
BODIES["q10_secure_restaurants"] = f"""
select restaurant_city, restaurant_id, restaurant_name, count(*) as total_orders, {gmv()} as gmv, {_RATING}, {_SENTIMENT}
from ({_visible('CITY_A')}) e group by 1, 2, 3
"""


def oracle_sql() -> dict[str, str]:
    return {key: _query(body) for key, body in BODIES.items()}
