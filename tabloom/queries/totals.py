"""Totals that are worked out from stored totals and not from the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.durable import new_folder
from tabloom.operators import lattice, sketches
from tabloom.queries.registry import query, table
from tabloom.sinks import publish_orc, read_published

_SIX = ["flag", "status", "line", "year", "discount", "tax"]


@query(
    "agg_cube_lattice",
    """select flag, status, line, year, discount, tax, count(*) as n, cast(sum(quantity) as bigint) as quantity,
              max(price) as highest, cast(grouping(flag, status, line, year, discount, tax) as bigint) as grouping
       from (select l_returnflag as flag, l_linestatus as status, l_linenumber as line,
                    cast(year(l_shipdate) as integer) as year, cast(round(l_discount * 100) as integer) as discount,
                    cast(round(l_tax * 100) as integer) as tax, cast(l_quantity as bigint) as quantity,
                    l_extendedprice as price from lineitem) t
       group by cube (flag, status, line, year, discount, tax)""",
)
def cube_lattice(spark, sf):
    """A cube of six columns, each of its 64 sets from the smallest finer one."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.col("l_linenumber").alias("line"),
        F.year("l_shipdate").alias("year"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount"),
        F.round(F.col("l_tax") * 100).cast("int").alias("tax"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )
    totals = {"n": lattice.rows(), "quantity": lattice.added("quantity"), "highest": lattice.highest("price")}
    return lattice.grouping_sets(lines, _SIX, lattice.cube(_SIX), totals)


@query(
    "agg_distinct_sketches",
    """select year(o_orderdate) as year, count(distinct o_custkey) as customers, true as estimate_is_close
       from orders group by year(o_orderdate)""",
)
def distinct_by_sketches(spark, sf):
    """Customers of each year from the stored sketches of its months: the exact number, and whether the estimate is near.

    A year is published by itself, so a new one leaves the others alone. Near is within four standard errors.
    """
    path = new_folder(spark, "sketches")
    orders = table(spark, sf, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    months = sketches.distinct_sketches(orders, ["year", "month"], ["o_custkey"])
    schema = ["customers;string", "month;int", "year;int"]
    publish_orc(months.select("o_custkey", "month", "year"), path, schema, ["year"])
    years = sketches.merged(read_published(spark, path), ["year"], ["customers"])
    exact = orders.distinct().groupBy("year").agg(F.count_distinct("o_custkey").alias("customers"))
    both = exact.join(years.select("year", sketches.estimate("customers").alias("estimate")), "year")
    near = F.abs(F.col("estimate") - F.col("customers")) <= 4 * sketches.relative_error() * F.col("customers") + 1
    return both.select("year", "customers", near.alias("estimate_is_close"))
