"""Dimension and range lookups."""

from pyspark.sql import functions as F

from tabloom import functions as fn
from tabloom.operators import Dimension, Limits, RangeDimension, dimension, in_range, stage
from tabloom.plans import Flow
from tabloom.queries.registry import query, table


@query(
    "flagship",
    """select n_name as nation, c_mktsegment as segment, count(*) as orders,
              sum(cast(round(o_totalprice * 100) as bigint)) / 100.0 as revenue
       from customer join nation on n_nationkey = c_nationkey join orders on o_custkey = c_custkey
       group by n_name, c_mktsegment""",
)
def flagship(spark, sf):
    """Revenue per nation and segment.

    Orders are summed per customer before the join, so a customer with very many orders meets
    it as a single row. Money is added in whole cents, which gives the same sum in any order.
    """
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    flow = (
        Flow(spark)
        .dimension("nation", Dimension(nation))
        .source(
            "shaped_customer",
            table(spark, sf, "customer"),
            steps=[{"nation": dimension("nation", "c_nationkey"), "segment": fn.to_str("c_mktsegment")}],
            schema=["c_custkey;long", "nation;string", "segment;string"],
        )
        .source("order_input", table(spark, sf, "orders"))
        .table(
            "customer_revenue",
            """select o_custkey, count(*) as orders, sum(cast(round(o_totalprice * 100) as bigint)) as cents
               from order_input group by o_custkey""",
        )
        .result(
            """select nation, segment, sum(orders) as orders, sum(cents) / 100.0D as revenue
               from customer_revenue join shaped_customer on o_custkey = c_custkey
               where nation is not null
               group by nation, segment"""
        )
    )
    return flow.union()


@query(
    "lookup_dimension",
    "select c_custkey, n_name as nation from customer left join nation on n_nationkey = c_nationkey",
)
def lookup_dimension(spark, sf):
    nation = Dimension(table(spark, sf, "nation").select("n_nationkey", "n_name"))
    return stage(table(spark, sf, "customer"), {"nation": dimension(nation, "c_nationkey")}).select(
        "c_custkey", "nation"
    )


@query(
    "lookup_fallback",
    """select c_custkey, coalesce(s_name, n_name) as name
       from customer left join supplier on s_suppkey = c_custkey left join nation on n_nationkey = c_nationkey""",
)
def lookup_fallback(spark, sf):
    names = Dimension(
        table(spark, sf, "supplier").select("s_suppkey", "s_name"),
        table(spark, sf, "nation").select("n_nationkey", "n_name"),
    )
    looked_up = stage(table(spark, sf, "customer"), {"name": dimension(names, "c_custkey", "c_nationkey")})
    return looked_up.select("c_custkey", "name")


@query(
    "lookup_in_expression",
    """select c_custkey, c_mktsegment || '/' || coalesce(s_name, 'null') as label,
              case when contains(n_name, '1') then 1 else 0 end as has_one
       from customer left join supplier on s_suppkey = c_custkey left join nation on n_nationkey = c_nationkey""",
)
def lookup_in_expression(spark, sf):
    """Looked-up values as operands; without a match the text is null, which a join of texts spells out."""
    supplier = Dimension(table(spark, sf, "supplier").select("s_suppkey", "s_name"))
    nation = Dimension(table(spark, sf, "nation").select("n_nationkey", "n_name"))
    outputs = {
        "label": fn.add("c_mktsegment", F.lit("/"), dimension(supplier, "c_custkey")),
        "has_one": fn.contains(dimension(nation, "c_nationkey"), "1"),
    }
    return stage(table(spark, sf, "customer"), outputs).select("c_custkey", *outputs)


@query(
    "lookup_null_key",
    """select segment, count(*) as customers, max(label) as label
       from (select nullif(c_mktsegment, 'BUILDING') as segment from customer)
            left join (select nullif(c_mktsegment, 'BUILDING') as k, max(c_name) as label from customer group by 1)
            on k is not distinct from segment
       group by segment""",
)
def lookup_null_key(spark, sf):
    """A null key finds the entry of the null key."""
    customer = table(spark, sf, "customer").withColumn("segment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    labels = Dimension(customer.select("segment", "c_name"))
    looked_up = stage(customer.select("segment"), {"label": dimension(labels, "segment")})
    return looked_up.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"), F.max("label").alias("label"))


@query(
    "lookup_latest",
    """select c_custkey, latest from customer
       left join (select o_custkey, arg_max(o_orderpriority, o_orderkey) as latest from orders group by o_custkey)
       on o_custkey = c_custkey""",
)
def lookup_latest(spark, sf):
    """Many rows per key: the one with the highest order key is the one looked up."""
    latest = Dimension(
        table(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_orderkey"), order_by="o_orderkey"
    )
    return stage(table(spark, sf, "customer"), {"latest": dimension(latest, "c_custkey")}).select(
        "c_custkey", "latest"
    )


def _lines_per_brand(spark, sf, limits):
    brand = Dimension(table(spark, sf, "part").select("p_partkey", "p_brand"), limits=limits)
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_quantity")
    lines = stage(lines, {"brand": dimension(brand, "l_partkey")})
    return lines.groupBy("brand").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").cast("bigint").alias("quantity")
    )


_LINES_PER_BRAND = """select p_brand as brand, count(*) as lines, cast(sum(l_quantity) as bigint) as quantity
                      from lineitem left join part on p_partkey = l_partkey group by p_brand"""


@query("lookup_shuffled", _LINES_PER_BRAND)
def lookup_shuffled(spark, sf):
    """The way taken by a map too large to broadcast."""
    return _lines_per_brand(spark, sf, Limits(broadcast=0))


@query("lookup_merged", _LINES_PER_BRAND)
def lookup_merged(spark, sf):
    """The way taken by a map of which not even a partition's share fits in memory."""
    return _lines_per_brand(spark, sf, Limits(broadcast=0, partition=0))


@query(
    "lookup_range",
    """with bands as (select s_nationkey, min(s_acctbal) as lo, max(s_acctbal) as hi from supplier group by s_nationkey)
       select c_custkey, (select s_nationkey from bands where c_acctbal between lo and hi
                          order by lo desc, hi desc, s_nationkey desc limit 1) as band
       from customer""",
)
def lookup_range(spark, sf):
    """Overlapping ranges, written as ``min_max`` keys."""
    bands = table(spark, sf, "supplier").groupBy("s_nationkey").agg(
        F.concat_ws("_", F.min("s_acctbal"), F.max("s_acctbal")).alias("range")
    )
    ranges = RangeDimension(bands.select("range", "s_nationkey"))
    return stage(table(spark, sf, "customer"), {"band": in_range(ranges, "c_acctbal")}).select("c_custkey", "band")


@query(
    "lookup_range_fallback",
    """with bands as (select s_nationkey, min(s_acctbal) as lo, max(s_acctbal) as hi
                      from supplier group by s_nationkey),
            keys as (select n_regionkey, min(n_nationkey) as lo, max(n_nationkey) as hi
                     from nation group by n_regionkey)
       select c_custkey, coalesce(
                (select s_nationkey from bands where c_acctbal between lo and hi
                 order by lo desc, hi desc, s_nationkey desc limit 1),
                (select n_regionkey from keys where c_nationkey between lo and hi
                 order by lo desc, hi desc, n_regionkey desc limit 1)) as band
       from customer""",
)
def lookup_range_fallback(spark, sf):
    bands = table(spark, sf, "supplier").groupBy("s_nationkey").agg(
        F.min("s_acctbal").alias("lo"), F.max("s_acctbal").alias("hi")
    )
    keys = table(spark, sf, "nation").groupBy("n_regionkey").agg(
        F.min("n_nationkey").alias("lo"), F.max("n_nationkey").alias("hi")
    )
    ranges = RangeDimension(bands.select("lo", "hi", "s_nationkey"), keys.select("lo", "hi", "n_regionkey"))
    looked_up = stage(table(spark, sf, "customer"), {"band": in_range(ranges, "c_acctbal", "c_nationkey")})
    return looked_up.select("c_custkey", "band")


_LATEST = """with bands as (select s_nationkey, min(s_acctbal) as lo, max(s_acctbal) as hi
                      from supplier group by s_nationkey)
       select c_custkey, (select {} from bands where c_acctbal between lo and hi
                          order by lo desc, hi desc, s_nationkey desc limit 1) as {}
       from customer"""


def _bands(spark, sf, value):
    bands = table(spark, sf, "supplier").groupBy("s_nationkey").agg(
        F.min("s_acctbal").alias("lo"), F.max("s_acctbal").alias("hi")
    )
    return RangeDimension(bands.select("lo", "hi", value.alias("v")))


@query("lookup_range_timestamp", _LATEST.format("epoch_ms(s_nationkey * 3600000)", "since"))
def lookup_range_timestamp(spark, sf):
    """Values that are instants."""
    since = _bands(spark, sf, F.timestamp_millis(F.col("s_nationkey").cast("bigint") * 3_600_000).cast("timestamp_ntz"))
    return stage(table(spark, sf, "customer"), {"since": in_range(since, "c_acctbal")}).select("c_custkey", "since")


@query("lookup_range_struct", _LATEST.format("s_nationkey + 1", "following"))
def lookup_range_struct(spark, sf):
    """Values that are records."""
    records = _bands(spark, sf, F.struct("s_nationkey", (F.col("s_nationkey") + 1).alias("a b")))
    found = stage(table(spark, sf, "customer"), {"record": in_range(records, "c_acctbal")})
    return found.select("c_custkey", F.col("record")["a b"].alias("following"))


@query(
    "lookup_range_many",
    """select c_custkey, (select max(s_suppkey) from supplier
                          where s_acctbal = (select max(s_acctbal) from supplier
                                             where c_acctbal between s_acctbal and s_acctbal + 100)) as supplier
       from customer""",
)
def lookup_range_many(spark, sf):
    """One range per supplier, taken apart over several tasks as a large map would be."""
    ranges = table(spark, sf, "supplier").select("s_acctbal", F.col("s_acctbal") + 100, "s_suppkey")
    many = RangeDimension(ranges, local_rows=0, slab_rows=100)
    return stage(table(spark, sf, "customer"), {"supplier": in_range(many, "c_acctbal")}).select(
        "c_custkey", "supplier"
    )
