"""DuckDB SQL oracles of the registered queries.

Each statement recomputes a query from the driver tables with plain SQL
(CASE, GROUP BY, window functions, FULL JOIN).  The derivation constants are
shared with ``stratum.sources.derive`` (data, not logic); every expression is
written out again here independently.

Typing rules: DuckDB integer ``sum`` is HUGEINT and ``hour``/``month``/``year``
are BIGINT, so the SQL casts explicitly to the Spark result types.
"""

from __future__ import annotations

from stratum.plans import layers as L
from stratum.sources import derive as D

VALID_STATUSES = "('Pending', 'Shipped', 'Completed', 'Cancelled')"


def _case(col: str, mapping: dict) -> str:
    arms = " ".join(f"when {col} = '{k}' then '{v}'" for k, v in mapping.items())
    return f"case {arms} end"


def _initcap(x: str) -> str:
    return ("list_aggregate(list_transform(string_split(" + x + ", ' '), "
            "lambda w: upper(left(w, 1)) || lower(substr(w, 2))), 'string_agg', ' ')")


def _money(cents: str) -> str:
    return f"(cast({cents} as double) / cast(100 as double))"


def _avg_money(s: str, n: str) -> str:
    return f"(cast((2 * {s} + {n}) // (2 * {n}) as double) / cast(100 as double))"


def _pct(p: str, w: str) -> str:
    return f"(cast((2000 * {p} + {w}) // (2 * {w}) as double) / cast(10 as double))"


_STATUS = " ".join(
    [f"when o_orderstatus = '{s}' and o_orderpriority = '{p}' then '{v}'"
     for (s, p), v in D.STATUS_OVERRIDES.items()]
    + [f"when o_orderstatus = '{s}' then '{v}'" for s, v in D.STATUS_BY_ORDERSTATUS.items()]
)

HEADER = f"""
header as (
  select o_orderkey as order_id, o_custkey as customer_id,
    strftime(o_orderdate + to_seconds(cast((o_orderkey * 7919) % 86400 as bigint)),
             '%Y-%m-%d %H:%M:%S') as order_timestamp_text,
    {_case('o_orderpriority', D.PAYMENT_BY_PRIORITY)} as payment_method,
    case {_STATUS} end as order_status
  from orders
)"""

LINES = HEADER + """,
lines as (
  select h.order_id, h.customer_id, h.payment_method, h.order_status,
    l.l_partkey as item_id, p.p_name as item_name, p.p_type as item_category,
    cast(p.p_retailprice as double) as item_price, cast(l.l_quantity as integer) as item_quantity,
    cast(p.p_retailprice as double) * cast(l.l_quantity as integer) as item_total,
    cast(round(cast(p.p_retailprice as double) * 100) as bigint) * cast(l.l_quantity as integer)
      as item_total_cents,
    strptime(h.order_timestamp_text, '%Y-%m-%d %H:%M:%S') as order_timestamp
  from header h
  join lineitem l on l.l_orderkey = h.order_id
  left join part p on p.p_partkey = l.l_partkey
),
silver as (
  select *, cast(order_timestamp as date) as order_date,
    cast(hour(order_timestamp) as integer) as order_hour,
    cast(month(order_timestamp) as integer) as order_month,
    cast(year(order_timestamp) as integer) as order_year
  from lines
),
clean as (select * from silver where coalesce(order_status in """ + VALID_STATUSES + """, false))"""

CUSTOMERS = f"""
bronze_customers as (
  select c_custkey as customer_id,
    case when c_acctbal < 0 then null else c_name end as customer_name,
    case when c_mktsegment = 'AUTOMOBILE' and c_acctbal > 9000 then null
         else strftime(date '{D.BIRTH_BASE}' + cast((c_custkey * 37) % {D.BIRTH_SPAN_DAYS} as integer),
                       '%Y-%m-%d') end as date_of_birth,
    case when c_nationkey = 3 then null
         else '+1 ' || lpad(cast((c_custkey * 7919) % 10000000000 as varchar), 10, '0') end as telephone,
    case when c_mktsegment = 'BUILDING' and c_acctbal < 1000 then null
         when c_mktsegment = 'MACHINERY' and c_acctbal >= 5000 and c_acctbal < 6000
           then lower(replace(c_name, '#', '.')) || '.example.com'
         else lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.com' end as email,
    '{D.CUSTOMER_CREATED}' as created_date
  from customer
),
typed_customers as (
  select customer_id, customer_name,
    cast(try_strptime(date_of_birth, '%Y-%m-%d') as date) as date_of_birth,
    telephone, email,
    cast(try_strptime(created_date, '%Y-%m-%d') as date) as created_date
  from bronze_customers
),
aged_customers as (
  select *, cast(floor(datediff('day', date_of_birth, date '{L.AS_OF}') / 365.25) as bigint) as age
  from typed_customers
),
silver_customers as (
  select *,
    case when age < 20 then 'Under 20' when age < 25 then '20-24' when age < 30 then '25-29'
         else '30+' end as age_group,
    case when email is not null then string_split(email, '@')[2] end as email_domain,
    cast((email is not null)::integer + (telephone is not null)::integer
         + (customer_name is not null)::integer as integer) as contact_completeness
  from aged_customers
)"""

ADDRESSES = f"""
bronze_addresses as (
  select c_custkey as customer_id,
    case when c_acctbal > 9900 then '  '
         else cast((c_custkey * 7) % 9999 + 1 as varchar) || ' ' || {_initcap('lower(c_mktsegment)')}
              || ' Street' end as address_line_1,
    case when n_nationkey = 24 then ' 24 ' else '  ' || lower(n_name) || ' ' end as city,
    case when c_acctbal < -900 then null else lower(r_name) end as state,
    case when c_acctbal >= 9800 and c_acctbal < 9900 then 'N/A'
         else lpad(cast((c_custkey * 389) % 100000 as varchar), 5, '0') end as postcode,
    '{D.CUSTOMER_CREATED}' as created_date
  from customer
  left join nation on c_nationkey = n_nationkey
  left join region on n_regionkey = r_regionkey
),
norm_addresses as (
  select customer_id, address_line_1, {_initcap('trim(city)')} as city, upper(trim(state)) as state,
    postcode, cast(try_strptime(created_date, '%Y-%m-%d') as date) as created_date
  from bronze_addresses
),
silver_addresses as (
  select *, concat_ws(', ', address_line_1, city, state, postcode) as full_address
  from norm_addresses
)"""


def _halves() -> str:
    split = D.EVENT_SPLIT
    return f"""
first_half as (select user_id, event_id, ts, event_type, value from events
               where ts < timestamp '{split}'),
second_half as (select user_id, event_id, ts, event_type, value from events
                where ts >= timestamp '{split}'),
first_latest as (
  select * exclude (rn) from (
    select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
    from first_half) where rn = 1),
second_latest as (
  select * exclude (rn) from (
    select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
    from second_half) where rn = 1),
initial_dim as (
  select user_id, event_id, event_type, value, date '{L.EFFECTIVE_FIRST}' as effective_start,
    cast(null as date) as effective_end, true as is_current
  from first_latest),
classified as (
  select coalesce(t.user_id, s.user_id) as user_id,
    case when t.user_id is null then 'new' when s.user_id is null then 'missing'
         when t.event_type is distinct from s.event_type then 'changed' else 'unchanged' end as _change,
    t.event_id as t_event_id, t.event_type as t_event_type, t.value as t_value,
    t.effective_start as t_start, t.effective_end as t_end, t.is_current as t_current,
    s.event_id as s_event_id, s.event_type as s_event_type, s.value as s_value
  from initial_dim t full join second_latest s on t.user_id = s.user_id)"""


def _dq_sql(cte: str, source: str, table: str, rules: list[tuple[str, str, str]],
            with_run_time: bool = True) -> str:
    parts = []
    stamp = f"'{L.RUN_TIME}' as run_time, " if with_run_time else ""
    for name, action, cond in rules:
        p = f"count(*) filter (where ({cond}))"
        f = f"count(*) filter (where not ({cond}))"
        n = f"count(*) filter (where ({cond}) is null)"
        parts.append(
            f"select {stamp}'{table}' as table_name, '{name}' as rule_name, "
            f"'{action}' as action, cast({p} as bigint) as pass_count, cast({f} as bigint) as fail_count, "
            f"cast({n} as bigint) as null_count, "
            f"case when {p} + {f} = 0 then cast(100.0 as double) else {_pct(p, f'({p} + {f})')} end "
            f"as pass_rate from {source}")
    return f"with {cte}\n" + "\nunion all\n".join(parts)


ORDER_RULES_SQL = [
    ("order_id_not_null", "fail", "order_id is not null"),
    ("customer_id_not_null", "fail", "customer_id is not null"),
    ("valid_order_status", "drop", f"order_status in {VALID_STATUSES}"),
    ("known_payment_method", "warn", "payment_method <> 'Unknown'"),
    ("positive_item_price", "warn", "item_price > 0"),
]
CUSTOMER_RULES_SQL = [
    ("customer_id_not_null", "fail", "customer_id is not null"),
    ("vaild_date_of_birth", "warn", f"date_of_birth < date '{L.AS_OF}'"),
    ("name_not_empty", "warn", "customer_name is not null and length(trim(customer_name)) > 0"),
    ("valid_email_format", "warn", "email is not null or email like '%@%.%'"),
    ("valid_phone_format", "warn", "telephone is not null or telephone like '+%'"),
]
ADDRESS_RULES_SQL = [
    ("addresses_has_customer_id", "fail", "customer_id is not null"),
    ("valid_postcode", "warn",
     "try_cast(postcode as integer) is not null and length(postcode) >= 4 and length(postcode) <= 6"),
    ("valid_state_format", "warn", "state is not null and regexp_matches(state, '^[A-Z]+$')"),
    ("valid_city_name", "warn", "city is not null and not regexp_matches(city, '^[0-9]+$')"),
    ("address_line_not_empty", "warn", "address_line_1 is not null and length(trim(address_line_1)) > 0"),
]

SILVER_LINE_COLS = ("order_id, customer_id, order_timestamp, payment_method, order_status, item_id, "
                    "item_name, item_category, item_price, item_quantity, item_total, item_total_cents, "
                    "order_date, order_hour, order_month, order_year")


def dq_orders_totals_sql() -> str:
    return _dq_sql(LINES, "silver", "silver_orders", ORDER_RULES_SQL, with_run_time=False)


def dq_quarantine_sql() -> str:
    """Lines by the rules they did not pass (a NULL condition is not passed), in rule order."""
    names = ", ".join(f"case when not coalesce({cond}, false) then '{name}' end" for name, _, cond in ORDER_RULES_SQL)
    drops = " or ".join(f"not coalesce({cond}, false)" for _, action, cond in ORDER_RULES_SQL if action == "drop")
    return f"""with {LINES}
select case when {drops} then 1 else 0 end as rejected, concat_ws(',', {names}) as failed_rules,
  count(*) as n_lines, cast(sum(item_total_cents) as bigint) as cents
from silver group by 1, 2"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["silver_order_lines"] = f"with {LINES}\nselect {SILVER_LINE_COLS} from silver"
    q["silver_calendar"] = f"""with {LINES}
select order_year, order_month, order_date, order_hour, count(*) as n_lines,
  count(distinct order_id) as n_orders
from silver group by all"""
    q["silver_customer"] = f"with {CUSTOMERS}\nselect * from silver_customers"
    q["silver_address"] = f"with {ADDRESSES}\nselect * from silver_addresses"
    q["dq_orders"] = _dq_sql(LINES, "silver", "silver_orders", ORDER_RULES_SQL)
    q["dq_customers"] = _dq_sql(CUSTOMERS, "silver_customers", "silver_customers", CUSTOMER_RULES_SQL)
    q["dq_addresses"] = _dq_sql(ADDRESSES, "silver_addresses", "silver_addresses", ADDRESS_RULES_SQL)
    q["dq_report"] = "\nunion all\n".join(
        f"select * from ({q[k]})" for k in ("dq_orders", "dq_customers", "dq_addresses"))
    q["dq_clean"] = f"with {LINES}\nselect {SILVER_LINE_COLS} from clean"
    q["gold_revenue_by_day"] = f"""with {LINES}
select order_date, order_month, order_year,
  {_money('sum(item_total_cents)')} as total_revenue,
  count(distinct order_id) as total_orders,
  {_avg_money('sum(item_total_cents)', 'count(item_total_cents)')} as avg_order_value,
  cast(sum(item_quantity) as bigint) as total_units_sold,
  {_avg_money('sum(item_total_cents)', 'count(distinct order_id)')} as avg_basket_value
from clean group by order_date, order_month, order_year"""
    q["gold_product_performance"] = f"""with {LINES}
select item_id, item_name, item_category,
  cast(sum(item_quantity) as bigint) as Total_units_sold,
  {_money('sum(item_total_cents)')} as Total_revenue,
  count(distinct order_id) as times_ordered,
  {_avg_money('sum(cast(round(item_price * 100) as bigint))', 'count(item_price)')} as avg_price
from clean group by item_id, item_name, item_category"""
    q["gold_status_funnel"] = f"""with {LINES},
g as (select order_status, count(distinct order_id) as order_count from clean group by order_status),
t as (select sum(order_count) as total from g)
select order_status, order_count, {_pct('order_count', 'total')} as pct_of_total from g, t"""
    q["gold_payment_mix"] = f"""with {LINES}
select payment_method, count(distinct order_id) as order_count,
  {_money('sum(item_total_cents)')} as total_revenue
from clean group by payment_method"""
    q["gold_customer_summary"] = f"""with {LINES}, {CUSTOMERS}, {ADDRESSES},
agg as (
  select customer_id, count(distinct order_id) as total_orders,
    {_money('sum(item_total_cents)')} as lifetime_value,
    {_avg_money('sum(item_total_cents)', 'count(item_total_cents)')} as avg_order_value,
    max(order_date) as last_order_date, min(order_date) as first_order_date,
    cast(datediff('day', max(order_date), date '{L.AS_OF}') as integer) as days_since_last_order,
    case when sum(item_total_cents) >= 100000 then 'VIP'
         when sum(item_total_cents) >= 50000 then 'Regular' else 'New' end as customer_segment
  from clean group by customer_id)
select agg.*, c.customer_name, c.age, c.age_group, c.email_domain, c.contact_completeness,
  a.city, a.state, a.full_address
from agg
left join silver_customers c on c.customer_id = agg.customer_id
left join silver_addresses a on a.customer_id = agg.customer_id"""
    # ---- SCD on the event halves
    h = _halves()
    q["scd1_upsert"] = f"""with {h}
select user_id, event_id, event_type, value from second_latest
union all
select user_id, event_id, event_type, value from first_latest
where user_id not in (select user_id from second_latest)"""
    q["scd2_initial"] = f"with {h}\nselect * from initial_dim"
    q["scd2_apply"] = f"""with {h}
select user_id, t_event_id as event_id, t_event_type as event_type, t_value as value,
  t_start as effective_start,
  case when _change = 'changed' then date '{L.EFFECTIVE_SECOND}' else t_end end as effective_end,
  case when _change = 'changed' then false else t_current end as is_current
from classified where _change <> 'new'
union all
select user_id, s_event_id, s_event_type, s_value, date '{L.EFFECTIVE_SECOND}', cast(null as date), true
from classified where _change in ('new', 'changed')"""
    q["scd2_changed_keys"] = f"with {h}\nselect user_id from classified where _change = 'changed'"
    q["scd2_new_keys"] = f"with {h}\nselect user_id from classified where _change = 'new'"
    q["scd2_metrics"] = f"with {h}\nselect _change, count(*) as keys from classified group by _change"
    q["scd2_current"] = f"""with {h}
select user_id, t_event_id as event_id, t_event_type as event_type, t_value as value,
  t_start as effective_start, t_end as effective_end, t_current as is_current
from classified where _change in ('unchanged', 'missing')
union all
select user_id, s_event_id, s_event_type, s_value, date '{L.EFFECTIVE_SECOND}', cast(null as date), true
from classified where _change in ('new', 'changed')"""
    q["scd2_history"] = """with
daily as (
  select * exclude (rn) from (
    select user_id, event_id, ts, event_type, value, cast(ts as date) as snapshot_date,
      row_number() over (partition by user_id, cast(ts as date) order by ts desc, event_id desc) as rn
    from events) where rn = 1),
flagged as (
  select *, row_number() over (partition by user_id order by snapshot_date) as k,
    lag(event_type) over (partition by user_id order by snapshot_date) as prev_type
  from daily),
versions as (select * from flagged where k = 1 or event_type is distinct from prev_type)
select user_id, event_id, event_type, value, snapshot_date as effective_start,
  lead(snapshot_date) over (partition by user_id order by snapshot_date) as effective_end,
  lead(snapshot_date) over (partition by user_id order by snapshot_date) is null as is_current
from versions"""
    return q
