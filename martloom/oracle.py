"""An independent SQL statement per query, in DuckDB's dialect, over the star-schema tables."""

from __future__ import annotations

from martloom import workloads as w
from martloom.operators import catalogue
from martloom.operators.quality import Rule


def _literals(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


LANDING_SQL = """
raw_customers as (select c_custkey as id, c_name as name from customer),
raw_stores as (
  select n_nationkey as id, n_name as name, date '2018-01-01' + n_nationkey * 30 as opened_at,
         cast(n_nationkey % 9 as double) / 100 as tax_rate
  from nation),
raw_orders as (
  select id, customer, ordered_at, store_id, order_total - tax_paid as subtotal, tax_paid, order_total
  from (select *, cast(floor(order_total * (store_id % 9) / 100) as bigint) as tax_paid
        from (select o_orderkey as id, o_custkey as customer, o_orderdate as ordered_at,
                     c_nationkey as store_id, cast(round(o_totalprice * 100) as bigint) as order_total
              from orders join customer on o_custkey = c_custkey))),
raw_items as (
  select concat_ws('-', l_orderkey::varchar, l_linenumber::varchar, l_partkey::varchar,
                   l_suppkey::varchar) as id,
         l_orderkey as order_id, l_partkey as sku
  from lineitem),
raw_products as (
  select p_partkey as sku, p_name as name, p_type as type,
         cast(round(p_retailprice * 100) as bigint) as price, p_brand as description
  from part),
raw_supplies as (
  select distinct l_suppkey as id, s_name as name, 10 + (l_suppkey * 7 + l_partkey * 3) % 200 as cost,
         l_suppkey % 2 = 0 as perishable, l_partkey as sku
  from lineitem join supplier on l_suppkey = s_suppkey),
raw_tweets as (
  select doc_id as id, user_id, ts as tweeted_at, text as content
  from documents join events on doc_id = event_id),
seed_events as (select event_id as id, user_id as item_id, ts::date as event_date from events)"""

STAGING_SQL = f"""
stg_customers as (select id as customer_id, name as customer_name from raw_customers),
stg_orders as (
  select id as order_id, customer as customer_id, ordered_at as order_date, store_id, subtotal,
         tax_paid, order_total, 'completed' as status
  from raw_orders),
stg_order_items as (select id as order_item_id, order_id, sku as product_id from raw_items),
stg_products as (
  select sku as product_id, name as product_name, type as product_type, description,
         price as product_price, type in ({_literals(w.FOOD_TYPES)}) as is_food_item,
         type in ({_literals(w.DRINK_TYPES)}) as is_drink_item
  from raw_products),
stg_stores as (select id as store_id, name as store_name, opened_at, tax_rate from raw_stores),
stg_supplies as (
  select id as supply_id, sku as product_id, name as supply_name, cost as supply_cost, perishable
  from raw_supplies),
stg_tweets as (select id, user_id, tweeted_at, content from raw_tweets),
supply_cost_by_product as (
  select product_id, sum(supply_cost)::bigint as supply_cost from stg_supplies group by 1)"""


def _half_away(total: str, n: str) -> str:
    """Integer quotient rounded half away from zero."""
    return (
        f"(case when {total} < 0 then -1 else 1 end)"
        f" * ((2 * abs({total}) + {n}) // (2 * nullif({n}, 0)))"
    )


def _v1(literal_macro: bool) -> str:
    profit = "p.product_price - coalesce(s.supply_cost, 0)"
    if literal_macro:
        profit = "p.product_price * 100 - coalesce(s.supply_cost, 0)"
    sums = ",\n".join(
        f"sum({column})::bigint as {kind}_{measure}_c"
        if kind == "total"
        else f"sum(case when is_{kind}_item then {column} else 0 end)::bigint as {kind}_{measure}_c"
        for measure, column in (("revenue", "price_c"), ("cost", "cost_c"), ("profit", "profit_c"))
        for kind in ("food", "drink", "total")
    )
    measures = [f"{k}_{m}" for m in ("revenue", "cost", "profit") for k in ("food", "drink", "total")]
    names = {m: m if m.startswith("total_") else f"total_{m}" for m in measures}
    customer_sums = ",\n".join(f"sum({m}_c)::bigint as {names[m]}_c" for m in measures)
    return f"""
v1_items_c as (
  select i.order_item_id, i.order_id, i.product_id, o.order_date, o.store_id, p.product_name,
         p.product_type, p.product_price as price_c, p.is_food_item, p.is_drink_item,
         s.supply_cost as cost_c, {profit} as profit_c
  from stg_order_items i
  left join stg_orders o on i.order_id = o.order_id
  left join stg_products p on i.product_id = p.product_id
  left join supply_cost_by_product s on i.product_id = s.product_id),
order_items as (
  select order_item_id, order_id, product_id, order_date, store_id, product_name,
         price_c::double / 100 as product_price, is_food_item, is_drink_item,
         cost_c::double / 100 as supply_cost, profit_c::double / 100 as gross_profit_per_item
  from v1_items_c),
v1_summary as (
  select order_id, sum(case when is_food_item then 1 else 0 end)::bigint as food_items_count,
         sum(case when is_drink_item then 1 else 0 end)::bigint as drink_items_count,
         count(*) as total_items_count, {sums}
  from v1_items_c group by 1),
v1_orders_c as (
  select o.order_id, o.customer_id, o.store_id, o.order_date, o.status, v.* exclude (order_id)
  from stg_orders o join v1_summary v using (order_id)),
orders_mart as (
  select order_id, customer_id, store_id, order_date, status, food_items_count, drink_items_count,
         total_items_count, {", ".join(f"{m}_c::double / 100 as {m}" for m in measures)}
  from v1_orders_c),
v1_customers_c as (
  select customer_id, min(order_date) as first_order_at, max(order_date) as most_recent_order_at,
         count(*) as number_of_orders, sum(food_items_count)::bigint as total_food_items,
         sum(drink_items_count)::bigint as total_drink_items,
         sum(total_items_count)::bigint as total_items, {customer_sums}
  from v1_orders_c group by 1),
customers_mart as (
  select c.customer_id, c.customer_name, s.first_order_at, s.most_recent_order_at, s.number_of_orders,
         s.total_food_items, s.total_drink_items, s.total_items,
         {", ".join(f"s.{n}_c::double / 100 as {n}" for n in names.values())},
         ({_half_away("s.total_revenue_c", "s.number_of_orders")})::double / 100 as avg_order_value,
         ({_half_away("s.total_profit_c", "s.number_of_orders")})::double / 100 as avg_order_profit
  from stg_customers c left join v1_customers_c s using (customer_id))"""


V2_SQL = """
v2_items as (
  select i.order_item_id, i.order_id, i.product_id, o.order_date as ordered_at, p.product_name,
         p.product_price, p.is_food_item, p.is_drink_item, s.supply_cost
  from stg_order_items i
  left join stg_orders o on i.order_id = o.order_id
  left join stg_products p on i.product_id = p.product_id
  left join supply_cost_by_product s on i.product_id = s.product_id),
v2_summary as (
  select order_id, sum(supply_cost)::bigint as order_cost,
         sum(product_price)::bigint as order_items_subtotal,
         count(order_item_id) as count_order_items,
         sum(case when is_food_item then 1 else 0 end)::bigint as count_food_items,
         sum(case when is_drink_item then 1 else 0 end)::bigint as count_drink_items
  from v2_items group by 1),
v2_orders as (
  select o.*, s.order_cost, s.order_items_subtotal, s.count_food_items, s.count_drink_items,
         s.count_order_items, s.count_food_items > 0 as is_food_order,
         s.count_drink_items > 0 as is_drink_order,
         row_number() over (partition by o.customer_id order by o.order_date, o.order_id)
           as customer_order_number
  from stg_orders o left join v2_summary s on o.order_id = s.order_id),
v2_customers as (
  select c.*, s.n as count_lifetime_orders, s.first_ordered_at, s.last_ordered_at, true as is_true,
         s.lifetime_spend_pretax, s.lifetime_tax_paid, s.lifetime_spend,
         case when s.n > 1 then 'returning' else 'new' end as customer_type
  from stg_customers c left join (
    select customer_id, count(distinct order_id) as n, min(order_date) as first_ordered_at,
           max(order_date) as last_ordered_at, sum(subtotal)::bigint as lifetime_spend_pretax,
           sum(tax_paid)::bigint as lifetime_tax_paid, sum(order_total)::bigint as lifetime_spend
    from stg_orders group by 1) s on c.customer_id = s.customer_id)"""

VALUES = {
    "dictionary": ", ".join(f"('{n}')" for n in w.DICTIONARY),
    "lexicon": ", ".join(f"('{t}', {round(v * 1_000_000)})" for t, v in w.LEXICON),
    "policies": ", ".join(
        f"('{d}', {s}, '{sev}', {every or 'null'})" for d, s, sev, every in w.POLICIES
    ),
}

BIN_SQL = """case when {x} > -1 and {x} <= -0.5 then 'Very Negative'
     when {x} > -0.5 and {x} <= -0.1 then 'Negative'
     when {x} > -0.1 and {x} <= 0.1 then 'Neutral'
     when {x} > 0.1 and {x} <= 0.5 then 'Positive'
     when {x} > 0.5 and {x} <= 1 then 'Very Positive' end"""

TEXT_SQL = f"""
dictionary(product_name) as (values {VALUES["dictionary"]}),
lexicon(token, valence) as (values {VALUES["lexicon"]}),
numbered as materialized (
  select *, row_number() over () as row_no from {{tweets}}),
mentions as (
  select t.row_no, t.id, t.tweeted_at, d.product_name
  from numbered t join dictionary d on contains(lower(t.content), lower(d.product_name))),
words as (
  select row_no, unnest(regexp_split_to_array(lower(content), '[^\\p{{{{L}}}}\\p{{{{M}}}}\\p{{{{N}}}}'']+')) as token
  from numbered),
scores as (
  select n.row_no, n.id, round(total / sqrt(total * total + 15.0), 6) as sentiment_score
  from numbered n join (
    select words.row_no, coalesce(sum(valence), 0)::double / 1000000 as total
    from words left join lexicon using (token) group by 1) using (row_no)),
scored_mentions as (
  select m.id, m.tweeted_at, m.product_name, s.sentiment_score
  from mentions m join scores s using (row_no)),
sentiment_means as (
  select product_name, sum(round(sentiment_score * 1000000)::bigint) / (count(*) * 1000000.0::double) as mean
  from scored_mentions group by 1),
product_sentiment as (
  select product_name, round(any_value(mean), 6) as avg_sentiment,
         count(sentiment_score) as mention_count,
         round(stddev_samp(sentiment_score), 6) as sentiment_std,
         min(tweeted_at) as first_mention, max(tweeted_at) as last_mention
  from scored_mentions join sentiment_means using (product_name) group by 1)"""
RULES_SQL = f"""
lexicon(token, valence) as (values {VALUES["lexicon"]}),
degrees(word, degree) as (values {", ".join(f"('{t}', {v}::double)" for t, v in w.RULE_WORDS.degrees.items())}),
loud as (
  select id, case when id::bigint % 3 = 0 then replace(replace(content, 'that', 'THAT'), ' the ', ' THE ')
                  else content end as content from stg_tweets),
spoken as (
  select id, case when id::bigint % 4 = 0 then replace(content, '.', '!')
                  when id::bigint % 5 = 0 then replace(content, '.', '?') else content end as content from loud),
split as (
  select id, regexp_extract_all(content, '[\\p{{L}}\\p{{M}}\\p{{N}}'']+') as t from spoken),
positions as (select id, unnest(t) as t, generate_subscripts(t, 1) as i from split),
read as (
  select id, i, valence as v, t = upper(t) and t <> lower(t) as caps,
         lower(t) in ({", ".join(f"'{x}'" for x in w.RULE_WORDS.negations)}) as negates,
         lower(t) in ({", ".join(f"'{x}'" for x in w.RULE_WORDS.contrasts)}) as contrasts,
         case when valence is null then coalesce(degree, 0) else 0 end as degree
  from positions left join lexicon on token = lower(t) left join degrees on word = lower(t)),
whole as (
  select id, count_if(caps) between 1 and count(*) - 1 as mixed, min(case when contrasts then i end) as turn
  from read group by id),
around as (
  select *, {", ".join(f"lag({c}, {k}) over (partition by id order by i) as {c}{k}" for k in (1, 2, 3) for c in ("degree", "caps", "negates"))}
  from read),
strength as (
  select a.*, turn, case when v < 0 then -1::double else 1::double end as s,
         case when caps and mixed then 0.733::double else 0::double end as own,
         {", ".join(f"coalesce(degree{k}, 0::double) + case when coalesce(degree{k}, 0) <> 0 and caps{k} and mixed then 0.733::double else 0::double end as d{k}" for k in (1, 2, 3))}
  from around a join whole using (id) where v is not null),
raised as (
  select *, v::double / 1000000 + s * own + s * d1 * 1::double + s * d2 * 0.95::double + s * d3 * 0.9::double as r
  from strength),
turned as (
  select id, r * {" * ".join(f"case when negates{k} then -0.74::double else 1::double end" for k in (1, 2, 3))}
    * case when turn is null or i = turn then 1::double when i < turn then 0.5::double else 1.5::double end as x
  from raised),
sums as (select id, sum(floor(x * 1000000 + 0.5::double)::bigint)::bigint as total from turned group by id),
marks as (
  select id, least(length(content) - length(replace(content, '!', '')), 4) * 0.292::double as noise,
         length(content) - length(replace(content, '?', '')) as asked from spoken),
strong as (
  select id, coalesce(total, 0)::double / 1000000 + sign(coalesce(total, 0)) * (noise + case
    when asked <= 1 then 0::double when asked <= 3 then asked * 0.18::double else 0.96::double end) as x
  from marks left join sums using (id))"""
REPEATED_TWEETS = """
repeated as (
  select case when id::bigint % 4 <> 0 then (id::bigint % 7)::varchar end as id, user_id, tweeted_at, content
  from stg_tweets),
repeated_tweets as (
  select * from repeated union all select * from repeated where user_id::bigint % 3 = 0)"""
TEXT_PARTS = TEXT_SQL
TEXT_SQL = TEXT_PARTS.format(tweets="stg_tweets")

RUNS_SQL = """
run_models as (
  select distinct '"mart"."' || event_type || '"."user_' || user_id || '"' as model from events),
runs as (
  select '"mart"."' || event_type || '"."user_' || user_id || '"' as model,
         epoch_us(ts) // 1000 as end_ms
  from events where event_type <> 'error')"""


def _with(*parts: str, select: str) -> str:
    return f"with {','.join(parts)}\n{select}"


def _staging(select: str) -> str:
    return _with(LANDING_SQL, STAGING_SQL, select=select)


def _v1_query(select: str, literal_macro: bool = False) -> str:
    return _with(LANDING_SQL, STAGING_SQL, _v1(literal_macro), select=select)


CHANGED_ITEMS = """
changed_items as (
  select * from raw_items where order_id % 100 <> 7
  union all by name
  select * replace (sku % 100 + 1 as sku) from raw_items where order_id % 200 = 7)"""


def _changed_query(select: str) -> str:
    """The dollar marts over changed items."""
    staging = STAGING_SQL.replace("from raw_items)", "from changed_items)")
    return _with(LANDING_SQL, CHANGED_ITEMS, staging, _v1(False), select=select)


def _v2_query(select: str) -> str:
    return _with(LANDING_SQL, STAGING_SQL, V2_SQL, select=select)


def _freshness(policies: str, dataset: str) -> str:
    return f"""with policies(dataset, max_lag_seconds, severity, every) as (values {policies}),
last as (select {dataset} as dataset, max(ts) as last_update from events group by 1),
lags as (
  select p.*, l.last_update,
         trunc((coalesce(as_of - as_of % (every::bigint * 1000000), as_of) - epoch_us(l.last_update))
               / 1000000)::bigint as lag_seconds
  from (select *, epoch_us(timestamp '{w.AS_OF}') as as_of from policies) p left join last l using (dataset))
select dataset, last_update, lag_seconds, max_lag_seconds, severity,
       coalesce(lag_seconds <= max_lag_seconds, false) as passed
from lags"""


# The tables of a listed schema with their declared types (fixed values).
CUSTOMER_COLUMNS = "[['customer_id', 'bigint'], ['customer_name', 'string']]"
ORDER_COLUMNS = """[['order_id', 'bigint'], ['customer_id', 'bigint'], ['order_date', 'timestamp_ntz'],
  ['store_id', 'int'], ['subtotal', 'bigint'], ['tax_paid', 'bigint'], ['order_total', 'bigint'],
  ['status', 'string']]"""
CATALOGUED = f"""select *, len(columns) as n_columns from (
  select 'customers' as table_name, true as is_stored, {CUSTOMER_COLUMNS} as columns, count(*) as n_rows
  from stg_customers
  union all select 'orders', true, {ORDER_COLUMNS}, count(*) from stg_orders
  union all select 'late_orders', false, {ORDER_COLUMNS}, count(*) from stg_orders where order_id > 100)"""


def _text(select: str) -> str:
    return _with(LANDING_SQL, STAGING_SQL, TEXT_SQL, select=select)


# Marts whose names are also star-schema tables go by another name in the statements.
SQL_NAMES = {"orders": "orders_mart", "customers": "customers_mart", "products": "stg_products",
             "supplies": "stg_supplies", "tweets": "stg_tweets", "product_sentiment": "sentiment_mart"}


def _rule_sql(rule: Rule) -> str:
    """One result row of a rule."""
    table = SQL_NAMES.get(rule.table, rule.table)
    head = (
        f"select '{rule.table}' as table_name, '{rule.label}' as column_name, '{rule.kind}' as rule,"
        f" '{rule.severity}' as severity"
    )
    tail = "n_rows, n_failed, n_failed = 0 as passed"
    if rule.kind == "required_columns":
        return f"{head}, null::bigint as n_rows, 0::bigint as n_failed, true as passed"
    if rule.kind == "row_count":
        counts = f"select count(*) as n_rows, (count(*) = 0)::bigint as n_failed from {table}"
    elif rule.kind in ("unique", "unique_combination"):
        keys = ", ".join(rule.columns)
        bad = "c > 1"
        if not rule.nulls_fail:
            bad += "".join(f" and {k} is not null" for k in rule.columns)
        counts = (
            f"select coalesce(sum(c), 0)::bigint as n_rows, count(*) filter (where {bad}) as n_failed"
            f" from (select {keys}, count(*) as c from {table} group by {keys})"
        )
    elif rule.kind == "relationships":
        column = rule.columns[0]
        parent = SQL_NAMES.get(rule.parent, rule.parent)
        counts = (
            f"select count(*) as n_rows, count(*) filter (where {column} is not null and {column}"
            f" not in (select {rule.parent_column} from {parent}"
            f" where {rule.parent_column} is not null)) as n_failed from {table}"
        )
    else:
        c = rule.columns[0]
        bad = []
        if rule.kind == "accepted_values":
            bad.append(f"{c} not in ({_literals(rule.values)})")
        if rule.low is not None:
            bad.append(f"{c} < {rule.low}")
        if rule.high is not None:
            bad.append(f"{c} > {rule.high}")
        if rule.nulls_fail:
            bad.append(f"{c} is null")
        counts = (
            f"select count(*) as n_rows, count(*) filter (where {' or '.join(bad)}) as n_failed"
            f" from {table}"
        )
    return f"{head}, {tail} from ({counts})"


def _rules_sql(rules: list[Rule]) -> str:
    return "\nunion all\n".join(_rule_sql(r) for r in rules)


def _verdict_sql(rules: list[Rule]) -> str:
    return f"""select table_name, count(*) as n_rules, count(*) filter (where not passed) as n_failed_rules,
       bool_and(passed or severity <> 'error') as passed
from ({_rules_sql(rules)}) group by 1"""


def _audit_sql(name: str, bad: str, table: str) -> str:
    return f"""select '{name}' as audit, n_rows, n_failed, n_failed = 0 as passed
from (select count(*) as n_rows, count(*) filter (where {bad}) as n_failed from {table})"""


START, END = w.RANGE
IN_RANGE = f"event_date between date '{START}' and date '{END}'"
SENTIMENT_MART = f"""
sentiment_mart as (
  select p.*, {BIN_SQL.format(x="mean")} as sentiment_category
  from product_sentiment p join sentiment_means using (product_name))"""
SEED_AS_INT = "select id::integer as id, item_id::integer as item_id, event_date from seed_events"
FULL_MODEL = "select item_id, count(distinct id) as num_orders from seed_events group by 1"

ORACLES: dict[str, str] = {
    **{
        name: _staging(f"select * from {name}")
        for name in (
            "stg_customers",
            "stg_orders",
            "stg_order_items",
            "stg_products",
            "stg_stores",
            "stg_supplies",
            "stg_tweets",
            "supply_cost_by_product",
        )
    },
    "v1_order_items": _v1_query("select * from order_items"),
    "v1_orders": _v1_query("select * from orders_mart"),
    "v1_customers": _v1_query("select * from customers_mart"),
    "v1_order_items_literal": _v1_query("select * from order_items", True),
    "v1_orders_literal": _v1_query("select * from orders_mart", True),
    "v1_customers_literal": _v1_query("select * from customers_mart", True),
    "mart_products": _staging("select * from stg_products"),
    "mart_supplies": _staging("select * from stg_supplies"),
    "mart_tweets": _staging("select * from stg_tweets"),
    "v2_order_items": _v2_query("select * from v2_items"),
    "v2_orders": _v2_query("select * from v2_orders"),
    "v2_orders_hot_keys": _v2_query("select * from v2_orders"),
    "v2_customers": _v2_query("select * from v2_customers"),
    "fn_cents_to_dollars": f"""select customer_id, s::double / 100 as dollars,
       ({_half_away("s", "10")})::double / 10 as dollars_1,
       ({_half_away("s", "100")})::double as dollars_0
from (select c_custkey as customer_id, cast(round(c_acctbal * 100) as bigint) as s from customer)""",
    "report_top_customers": _v1_query(
        """select customer_name, total_revenue, number_of_orders, avg_order_value
from customers_mart order by total_revenue desc nulls last, customer_id limit 10"""
    ),
    "report_sales_by_type_month": _v1_query(
        """select date_trunc('month', order_date)::date as month, product_type,
       count(*) as number_of_items, sum(price_c)::bigint::double / 100 as total_revenue,
       sum(profit_c)::bigint::double / 100 as total_profit
from v1_items_c group by 1, 2 order by 1, 2"""
    ),
    "report_store_performance": _v1_query(
        """select s.store_name, count(distinct o.order_id) as number_of_orders,
       sum(o.total_revenue_c)::bigint::double / 100 as total_revenue,
       sum(o.total_profit_c)::bigint::double / 100 as total_profit,
       round(avg(o.total_items_count), 6) as avg_items_per_order
from v1_orders_c o join stg_stores s on o.store_id = s.store_id
group by 1 order by total_revenue desc nulls last, 1"""
    ),
    "report_profitable_products": _v1_query(
        """select product_name, product_type, count(*) as times_ordered,
       round(sum(profit_c)::bigint::double / count(profit_c) / 100, 6) as avg_profit_per_item,
       sum(profit_c)::bigint::double / 100 as total_profit
from v1_items_c group by 1, 2
order by total_profit desc nulls last, product_name, product_type limit 10"""
    ),
    "mention_extract": _text("select id, product_name from mentions"),
    "mention_extract_blocks": _text("select id, product_name from mentions"),
    "mention_large_dictionary": """with names as (
  select distinct unnest(regexp_extract_all(lower(text), '[a-z]+')) as product_name
  from benchmark)
select product_name, count(*) as mention_count
from documents join names on contains(lower(text), product_name) group by 1""",
    **{
        name: _with(
            LANDING_SQL,
            STAGING_SQL,
            REPEATED_TWEETS,
            TEXT_PARTS.format(tweets="repeated_tweets"),
            select="select * from scored_mentions",
        )
        for name in ("mention_repeated_ids", "mention_repeated_ids_blocks")
    },
    "lexicon_score": _text("select id, sentiment_score from scores"),
    "sentiment_rules_score": _with(
        LANDING_SQL,
        STAGING_SQL,
        RULES_SQL,
        select="select id, round(x / sqrt(x * x + 15::double), 6) as sentiment_score from strong",
    ),
    "sentiment_bins": _text(
        f"""select id, c as sentiment_category,
       case c when 'Very Negative' then 1 when 'Negative' then 2 when 'Neutral' then 3
              when 'Positive' then 4 when 'Very Positive' then 5 end as category_rank
from (select id, {BIN_SQL.format(x="sentiment_score")} as c from scores)"""
    ),
    "mention_stats": _text("select * from product_sentiment"),
    "product_sentiment": _with(
        LANDING_SQL, STAGING_SQL, TEXT_SQL, SENTIMENT_MART, select="select * from sentiment_mart"
    ),
    "seed_events": _with(LANDING_SQL, select="select * from seed_events"),
    "incremental_range": _with(LANDING_SQL, select=f"select * from seed_events where {IN_RANGE}"),
    "incremental_rerun": _with(
        LANDING_SQL,
        select=f"""select s.* from seed_events s join events e on s.id = e.event_id
where not ({IN_RANGE}) or event_type <> 'error'""",
    ),
    "full_model": _with(LANDING_SQL, select=FULL_MODEL),
    "missing_intervals": """with days as (select 'user_' || user_id as model, ts::date as day from events),
expected as (
  select model, unnest(generate_series(min(day)::timestamp, max(day)::timestamp, interval 1 day))::date as day
  from days group by 1)
select model, day from expected except select model, day from days""",
    "last_materialized": _with(
        RUNS_SQL,
        select="""select model, array_to_string(regexp_extract_all(model, '"([^"]+)"', 1), '/') as model_path,
       max(end_ms) as last_end_ms, make_timestamp(max(end_ms) * 1000) as last_end_at,
       coalesce(strftime(make_timestamp(max(end_ms) * 1000), '%Y-%m-%d %H:%M:%S') || ' (UTC)',
                'never materialized') as label
from run_models left join runs using (model) group by model""",
    ),
    "parse_model_name": _with(
        RUNS_SQL,
        select="""select model, array_to_string(regexp_extract_all(model, '"([^"]+)"', 1), '|') as parts
from run_models""",
    ),
    "freshness": _freshness(VALUES["policies"], "event_type"),
    # Written out, not taken from the library: the declared policies.
    "freshness_policies": _freshness(
        """('customers', 3600, 'error', null), ('orders', 3600, 'error', null),
  ('stg_orders', 7200, 'error', null), ('stg_stores', 7200, 'error', null),
  ('stg_products', 7200, 'error', null), ('stg_supplies', 7200, 'error', null),
  ('tweets', 60, 'warn', 300)""",
        """case event_type when 'click' then 'customers' when 'error' then 'orders'
  when 'purchase' then 'stg_orders' when 'signup' then 'stg_products' when 'view' then 'tweets' end""",
    ),
    "catch_up": _with(LANDING_SQL, select=f"select * from seed_events where {IN_RANGE}"),
    "catch_up_emptied_day": _with(
        LANDING_SQL, select=f"select * from seed_events where {IN_RANGE} and event_date <> date '{END}'"
    ),
    "delta_orders": _changed_query("select * from orders_mart"),
    "delta_customers": _changed_query("select * from customers_mart"),
    "colocated_orders": _v1_query("select * from orders_mart"),
    "colocated_customers": _v1_query("select * from customers_mart"),
    "rebuild_atomic": _with(
        LANDING_SQL,
        select=f"""select s.* from seed_events s join events e on s.id = e.event_id
where not ({IN_RANGE}) or event_type <> 'error' and event_date <> date '{START}'""",
    ),
    "full_model_from_days": _with(
        LANDING_SQL,
        select=f"""select item_id, count(distinct id) as num_orders
from seed_events s join events e on s.id = e.event_id
where event_date <> date '{START}' or event_type <> 'error' group by 1""",
    ),
    "streamed_landing": _with(LANDING_SQL, select=SEED_AS_INT),
    "csv_scan": _with(
        LANDING_SQL,
        select="""select sku::varchar as sku, name, type, price::integer as price, description
from raw_products""",
    ),
    "csv_all_text": _with(
        LANDING_SQL,
        select="""select id::varchar as id, name, opened_at::varchar as opened_at,
       tax_rate::varchar as tax_rate from raw_stores""",
    ),
    "typed_tweets": _with(
        LANDING_SQL,
        select="select id::varchar as id, user_id::varchar as user_id, tweeted_at, content from raw_tweets",
    ),
    "seed_load": _with(LANDING_SQL, select=SEED_AS_INT),
    "keyed_load": _with(LANDING_SQL, select="select id::varchar as id, name from raw_customers"),
    "materialize_kinds": _staging(
        "select *, 'view' as kind from stg_products union all select *, 'table' from stg_products"
    ),
    "qualify_name": _staging(
        """select *, 'default' as place from stg_stores
union all select *, 'custom' from stg_stores where store_id % 2 = 0"""
    ),
    "flush_schema": _staging(
        f"""select moment, table_name, n_columns::integer as n_columns,
       case when moment = 'before' then n_rows else 0 end as n_rows
from ({CATALOGUED}) cross join (values ('before'), ('after')) w(moment)"""
    ),
    "catalog_list": _staging(
        f"""select table_name, is_stored, c[1] as column_name, c[2] as data_type, n_rows
from (select *, unnest(columns) as c from ({CATALOGUED}))"""
    ),
    "write_replace": _staging("select * from stg_orders"),
    "write_truncate_load": _staging("select * from stg_customers"),
    "export_csv": _v1_query("select * from customers_mart"),
    "export_json": _staging("select * from stg_products"),
    "export_parquet": _v1_query("select * from orders_mart"),
    **{key: _staging(_rules_sql(rules)) for key, rules in w.STAGED_CHECKS.items()},
    "failing_relationships": _staging(
        "select * from stg_orders where order_id not in (select order_id from stg_order_items)"
    ),
    "failing_unique_combo": _staging(
        """select * from stg_order_items where (order_id, product_id) in
  (select (order_id, product_id) from stg_order_items
   group by order_id, product_id having count(*) > 1)"""
    ),
    "audit_negative_items": _with(
        LANDING_SQL,
        f"\nfull_model as ({FULL_MODEL})",
        select=_audit_sql("positive_item_ids", "item_id < 0", "full_model"),
    ),
    "audit_negative_balance": _audit_sql("negative_balance", "c_acctbal < 0", "customer"),
    "check_required_columns": _staging(_rules_sql(w.REQUIRED)),
    "contract_check": _staging(
        """select c.* exclude (n), n as n_values
from (select count(*) as rows, count(case when order_total % 2 = 0 then 1 end) as even from raw_orders),
lateral (values
  ('id', 'string', 'string', 'ok', rows), ('customer', 'string', 'string', 'ok', rows),
  ('ordered_at', 'timestamp_ntz', 'timestamp_ntz', 'ok', rows), ('store_id', 'string', null, 'missing', 0),
  ('subtotal', 'int', 'double', 'type_mismatch', rows), ('tax_paid', 'int', 'int', 'ok', rows),
  ('order_total', 'int', 'int', 'ok', rows), ('channel', null, 'string', 'unexpected', even)
) c("column", expected, actual, status, n)"""
    ),
    "gate_blocks": _staging("select * from stg_orders"),
    "publish_observed": _v1_query(_rules_sql([r for rules in w.PUBLISHED.values() for r in rules])),
    "check_sentiment": _with(
        LANDING_SQL,
        STAGING_SQL,
        TEXT_SQL,
        SENTIMENT_MART,
        select=_rules_sql(catalogue.sentiment_rules()),
    ),
    "check_all": _v1_query(_rules_sql(w.all_rules())),
    "check_verdict": _staging(
        _verdict_sql(catalogue.landing_rules() + catalogue.staging_rules(w.PRODUCT_TYPES))
    ),
}
