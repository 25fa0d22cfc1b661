"""What the SQL step reaches in Spark SQL, one query per kind.

The statements are written for tables in which one key may hold much of the data: a fact
table is reduced per key before it is joined, windows run over daily totals rather than over
raw events, and grouping sets over the finest totals, so that it is not the table that is
multiplied. Money is added in whole cents, which gives the same sum in any order.
"""

from tabloom.plans import Flow
from tabloom.queries.registry import query, table


def _sql(name, tables, statement, oracle=None):
    """Register a statement over the given tables; by default it is its own oracle."""

    def run(spark, sf):
        flow = Flow(spark)
        for t in tables.split():
            flow.source(t, table(spark, sf, t))
        return flow.result(statement).union()

    query(name, oracle or statement)(run)


_sql(
    "where_predicates",
    "customer",
    """select c_custkey, 'c' as kind, c_acctbal + 1 as raised from customer
       where (c_mktsegment in ('BUILDING', 'MACHINERY') or c_name like '%7')
         and not (c_acctbal between 0 and 500) and c_nationkey is not null and c_nationkey <> 3""",
)

_PER_CUSTOMER = """(select o_custkey, count(*) as orders, sum(cast(round(o_totalprice * 100) as bigint)) as cents
                    from orders group by o_custkey)"""

_sql(
    "join_inner",
    "customer orders",
    f"""select c_custkey, c_name, orders, cast(cents as bigint) as cents
        from customer join {_PER_CUSTOMER} o on o_custkey = c_custkey""",
)
_sql(
    "join_left",
    "customer orders",
    f"""select c_custkey, coalesce(orders, 0) as orders
        from customer left join {_PER_CUSTOMER} o on o_custkey = c_custkey""",
)
_sql(
    "join_right",
    "customer orders",
    f"""select c_custkey, c_name, orders from {_PER_CUSTOMER} o right join customer on o_custkey = c_custkey""",
)
_sql(
    "join_full",
    "customer supplier",
    """select c_custkey, s_suppkey, coalesce(c_name, s_name) as name
       from customer full join (select s_suppkey + 50 as s_suppkey, s_name from supplier) s on s_suppkey = c_custkey""",
)
_sql(
    "join_semi",
    "customer orders",
    """select c_custkey, c_name from customer
       where exists (select 1 from (select distinct o_custkey from orders where o_orderstatus = 'P') o
                     where o_custkey = c_custkey)""",
)
_sql(
    "join_anti",
    "customer orders",
    """select c_custkey, c_name from customer
       where not exists (select 1 from (select distinct o_custkey from orders where o_orderstatus = 'P') o
                         where o_custkey = c_custkey)""",
)
_sql(
    "agg_group",
    "lineitem",
    """select l_returnflag, l_linestatus, count(*) as n_lines, cast(sum(l_quantity) as bigint) as quantity,
              sum(cast(round(l_extendedprice * 100) as bigint)) / 100.0D as price,
              min(l_discount) as lowest, max(l_tax) as highest
       from lineitem group by l_returnflag, l_linestatus having count(*) > 10""",
    oracle="""select l_returnflag, l_linestatus, count(*) as n_lines, cast(sum(l_quantity) as bigint) as quantity,
              cast(sum(cast(round(l_extendedprice * 100) as bigint)) as double) / 100.0 as price,
              min(l_discount) as lowest, max(l_tax) as highest
       from lineitem group by l_returnflag, l_linestatus having count(*) > 10""",
)
_sql(
    "agg_distinct",
    "orders",
    """select o_orderpriority, count(distinct o_custkey) as customers, count(distinct o_orderstatus) as statuses
       from (select distinct o_orderpriority, o_custkey, o_orderstatus from orders) t group by o_orderpriority""",
)
_sql(
    "select_distinct",
    "lineitem",
    "select distinct l_returnflag, l_linestatus, l_linenumber from lineitem",
)
_sql(
    "agg_grouping_sets",
    "orders",
    """select o_orderstatus, o_orderpriority, cast(sum(n) as bigint) as orders
       from (select o_orderstatus, o_orderpriority, count(*) as n from orders
             group by o_orderstatus, o_orderpriority) t
       group by grouping sets ((o_orderstatus, o_orderpriority), (o_orderstatus), ())""",
)
_sql(
    "agg_rollup",
    "lineitem",
    """select l_returnflag, l_linestatus, cast(grouping(l_linestatus) as int) as all_statuses,
              cast(sum(n) as bigint) as n_lines
       from (select l_returnflag, l_linestatus, count(*) as n from lineitem group by l_returnflag, l_linestatus) t
       group by rollup (l_returnflag, l_linestatus)""",
)
_sql(
    "agg_cube",
    "customer",
    """select c_mktsegment, c_nationkey, cast(sum(n) as bigint) as customers
       from (select c_mktsegment, c_nationkey, count(*) as n from customer group by c_mktsegment, c_nationkey) t
       group by cube (c_mktsegment, c_nationkey)""",
)

_DAILY = """(select event_type, cast(ts as date) as day, count(*) as events,
                    sum(cast(round(value * 100) as bigint)) as cents
             from events group by event_type, cast(ts as date)) d"""

_sql(
    "win_rank",
    "events",
    f"""select event_type, cast(day as string) as day, events,
               cast(row_number() over (partition by event_type order by events desc, day) as int) as place,
               cast(rank() over (partition by event_type order by events desc) as int) as ranked,
               cast(dense_rank() over (partition by event_type order by events desc) as int) as dense,
               cast(ntile(4) over (partition by event_type order by events desc, day) as int) as quarter
        from {_DAILY}""",
)
_sql(
    "win_analytic",
    "events",
    f"""select event_type, cast(day as string) as day,
               cast(lag(cents) over w as bigint) as before, cast(lead(cents, 2, 0) over w as bigint) as later,
               cast(first_value(cents) over w as bigint) as opening,
               cast(last_value(cents) over (partition by event_type order by day
                    rows between unbounded preceding and unbounded following) as bigint) as closing
        from {_DAILY} window w as (partition by event_type order by day)""",
)
_sql(
    "win_frame_rows",
    "events",
    f"""select event_type, cast(day as string) as day,
               cast(sum(cents) over (partition by event_type order by day
                    rows between 6 preceding and current row) as bigint) as week
        from {_DAILY}""",
)
_RANGE_FRAME = """select event_type, cast(day as string) as day,
               cast(sum(cents) over (partition by event_type order by n
                    range between 6 preceding and 1 following) as bigint) as week
        from (select *, {day_number} as n from {daily}) t"""

_sql(
    "win_frame_range",
    "events",
    _RANGE_FRAME.format(day_number="unix_date(day)", daily=_DAILY),
    oracle=_RANGE_FRAME.format(day_number="day - date '1970-01-01'", daily=_DAILY),
)
_sql(
    "win_topk_per_key",
    "orders",
    """select * from (
           select o_custkey, o_orderkey, o_totalprice,
                  cast(row_number() over (partition by o_custkey
                                          order by o_totalprice desc, o_orderkey) as int) as place
           from orders) t
       where place <= 3""",
)
_sql(
    "topk",
    "orders",
    "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100",
)

_sql(
    "set_union_all",
    "customer supplier",
    "select c_nationkey as nation from customer union all select s_nationkey from supplier",
)
_sql(
    "set_union",
    "customer supplier",
    """select c_nationkey as nation, c_acctbal > 0 as solvent from customer
       union select s_nationkey, s_acctbal > 0 from supplier""",
)
_sql(
    "set_intersect",
    "customer orders",
    """select c_custkey as custkey from customer
       intersect select o_custkey from (select distinct o_custkey from orders) o""",
)
_sql(
    "set_except",
    "customer orders",
    """select c_custkey as custkey from customer
       except select o_custkey from (select distinct o_custkey from orders where o_orderstatus = 'P') o""",
)
_sql(
    "subquery_scalar",
    "orders",
    """select o_orderpriority, count(*) as orders from orders
       where o_totalprice > (select max(o_totalprice) / 2 from orders where o_orderstatus = 'O')
       group by o_orderpriority""",
)
_sql(
    "subquery_correlated",
    "customer supplier",
    """select c_custkey, c_acctbal from customer
       where c_acctbal > (select max(s_acctbal) * 0.5D from supplier where s_nationkey = c_nationkey)""",
    oracle="""select c_custkey, c_acctbal from customer
       where c_acctbal > (select max(s_acctbal) * 0.5 from supplier where s_nationkey = c_nationkey)""",
)
_sql(
    "subquery_cte",
    "orders customer",
    f"""with per_customer as (select * from {_PER_CUSTOMER} p),
             busy as (select o_custkey, orders from per_customer where orders >= 10)
        select c_nationkey, count(*) as busy_customers, max(orders) as most
        from busy join customer on c_custkey = o_custkey group by c_nationkey""",
)
_sql(
    "scalar_text",
    "customer",
    """select c_custkey, upper(c_mktsegment) as up, length(c_name) as size, substr(c_name, 10) as digits,
              replace(c_name, '#', '-') as dashed, trim(concat('  ', c_mktsegment, ' ')) as trimmed,
              lpad(cast(c_nationkey as string), 4, '0') as padded, reverse(c_mktsegment) as backwards
       from customer""",
)
_sql(
    "scalar_date",
    "orders",
    """select o_orderkey, extract(year from o_orderdate) as year, extract(quarter from o_orderdate) as quarter,
              cast(date_trunc('month', o_orderdate) as date) = cast(o_orderdate as date) as first_day,
              cast(last_day(cast(o_orderdate as date)) as string) as month_end
       from orders""",
    oracle="""select o_orderkey, cast(extract(year from o_orderdate) as integer) as year,
              cast(extract(quarter from o_orderdate) as integer) as quarter,
              cast(date_trunc('month', o_orderdate) as date) = cast(o_orderdate as date) as first_day,
              cast(last_day(cast(o_orderdate as date)) as varchar) as month_end
       from orders""",
)
_sql(
    "scalar_math",
    "part",
    """select p_partkey, abs(p_size - 25) as distance, p_size % 7 as rest, floor(p_retailprice) as whole,
              ceil(p_retailprice) as above, sqrt(cast(p_size * p_size as double)) as root,
              case when p_size > 25 then greatest(p_size, 30) else least(p_size, 20) end as bounded,
              sign(cast(p_size - 25 as double)) as side
       from part""",
    oracle="""select p_partkey, abs(p_size - 25) as distance, p_size % 7 as rest,
              cast(floor(p_retailprice) as bigint) as whole, cast(ceil(p_retailprice) as bigint) as above,
              sqrt(cast(p_size * p_size as double)) as root,
              case when p_size > 25 then greatest(p_size, 30) else least(p_size, 20) end as bounded,
              cast(sign(p_size - 25) as double) as side
       from part""",
)
_sql(
    "json_extract",
    "events",
    """select event_type, cast(get_json_object(props, '$.k') as int) as k, count(*) as events
       from events group by event_type, cast(get_json_object(props, '$.k') as int)""",
    oracle="""select event_type, cast(json_extract_string(props, '$.k') as integer) as k, count(*) as events
       from events group by 1, 2""",
)
_sql(
    "map_functions",
    "events",
    """select event_id, from_json(props, 'map<string,int>')['k'] as k,
              size(map_keys(from_json(props, 'map<string,int>'))) as n_keys,
              size(map_filter(from_json(props, 'map<string,int>'), (name, n) -> n > 50)) as n_high
       from events""",
    oracle="""select event_id, cast(json_extract_string(props, '$.k') as integer) as k,
              cast(len(json_keys(props)) as integer) as n_keys,
              cast(cast(json_extract_string(props, '$.k') as integer) > 50 as integer) as n_high
       from events""",
)
_sql(
    "array_explode",
    "documents",
    """select lang, word, count(*) as uses
       from documents lateral view explode(split(text, ' ')) w as word group by lang, word""",
    oracle="""select lang, word, count(*) as uses
       from (select lang, unnest(string_split(text, ' ')) as word from documents) group by lang, word""",
)
_sql(
    "array_functions",
    "embeddings",
    """select vec_id, size(embedding) as width, size(filter(embedding, x -> x > 0)) as positive,
              size(transform(embedding, x -> x * 2)) as doubled from embeddings""",
    oracle="""select vec_id, cast(len(embedding) as integer) as width,
              cast(len(list_filter(embedding, lambda x: x > 0)) as integer) as positive,
              cast(len(embedding) as integer) as doubled from embeddings""",
)


@query(
    "agg_approx_distinct",
    """select o_orderpriority, count(distinct o_custkey) as customers, true as estimate_is_close
       from orders group by o_orderpriority""",
)
def approx_distinct(spark, sf):
    """The exact number, and whether the estimate lies within three times its error of 2 %."""
    flow = Flow(spark).source("orders", table(spark, sf, "orders"))
    flow.table(
        "counted",
        """select o_orderpriority, count(distinct o_custkey) as customers,
                  approx_count_distinct(o_custkey, 0.02) as estimate from orders group by o_orderpriority""",
    )
    flow.result(
        """select o_orderpriority, customers, abs(estimate - customers) <= 0.06 * customers + 1 as estimate_is_close
           from counted"""
    )
    return flow.union()
