"""Projection to a schema and stages."""

from pyspark.sql import functions as F

from tabloom import functions as fn
from tabloom.operators import project, project_json, rename_to, stage, stages, strip_prefix
from tabloom.queries.registry import query, table


@query(
    "project_cast",
    """select cast(c_custkey as varchar) as c_custkey, cast(c_nationkey as bigint) as c_nationkey,
              cast(null as double) as absent, c_name from customer""",
)
def project_cast(spark, sf):
    schema = ["c_custkey;string", "c_nationkey;long", "absent;double", "c_name;string"]
    return project(table(spark, sf, "customer"), schema)


@query(
    "project_types",
    """select cast(l_orderkey as integer) as l_orderkey, cast(l_linenumber as smallint) as l_linenumber,
              cast(l_quantity as bigint) as l_quantity,
              cast(cast(l_extendedprice as float) as double) as l_extendedprice,
              l_tax <> 0 as l_tax, l_returnflag, strftime(l_shipdate, '%Y-%m-%d') as l_shipdate from lineitem""",
)
def project_types(spark, sf):
    schema = [
        "l_orderkey;int",
        "l_linenumber;short",
        "l_quantity;long",
        "l_extendedprice;float",
        "l_tax;boolean",
        "l_returnflag;string",
        "l_shipdate;date",
    ]
    typed = project(table(spark, sf, "lineitem"), schema)
    as_double, as_text = F.col("l_extendedprice").cast("double"), F.col("l_shipdate").cast("string")
    return typed.withColumns({"l_extendedprice": as_double, "l_shipdate": as_text})


@query(
    "rename_positional",
    "select c_name as c_mktsegment, c_mktsegment as c_name, c_custkey as id from customer",
)
def rename_positional(spark, sf):
    df = table(spark, sf, "customer").select("c_name", "c_mktsegment", "c_custkey")
    return rename_to(df, ["c_mktsegment;string", "c_name;string", "id;long"])


def _family_columns(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("rowkey"),
        F.col("c_name").alias("d:name"),
        F.col("c_mktsegment").alias("d:segment"),
        F.col("c_nationkey").alias("d:nation"),
    )


@query(
    "strip_prefix",
    "select c_mktsegment as segment, c_name as name, cast(null as varchar) as phone from customer",
)
def strip_family(spark, sf):
    return strip_prefix(_family_columns(spark, sf), ["d:segment", "d:name", "d:phone"])


@query(
    "project_json",
    """select cast(c_custkey as varchar) as rowkey, c_name as name, cast(c_nationkey as varchar) as nation,
              cast(null as varchar) as segment from customer""",
)
def project_as_json(spark, sf):
    rows = project_json(_family_columns(spark, sf), ["rowkey", "d:name", "d:nation", "d:phone"])
    return rows.select(
        *(F.get_json_object("json", f"$.{n}").alias(n) for n in ("rowkey", "name", "nation", "segment"))
    )


@query(
    "stage_swap",
    "select o_orderkey, o_orderpriority as o_orderstatus, o_orderstatus as o_orderpriority from orders",
)
def stage_swap(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return stage(orders, {"o_orderstatus": "o_orderpriority", "o_orderpriority": "o_orderstatus"})


@query(
    "stage_missing_column",
    "select c_custkey, cast(null as varchar) as phone, c_name || 'null' as label from customer",
)
def stage_missing_column(spark, sf):
    """A column the table lacks reads as null where that is asked for."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    outputs = {"phone": "c_phone", "label": fn.add("c_name", "c_phone")}
    return stage(customer, outputs, missing_as_null=True).select("c_custkey", "phone", "label")


@query(
    "stage_chain",
    """select o_orderkey,
              'C' || lpad(cast(o_custkey as varchar), 8, '0') || '/' || o_orderstatus as code,
              case when o_orderstatus = 'F' then 'closed' else 'open' end as state,
              case when contains('C' || lpad(cast(o_custkey as varchar), 8, '0') || '/' || o_orderstatus, '/P')
                   then 1 else 0 end as pending
       from orders""",
)
def stage_chain(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    digits = F.lpad(F.col("o_custkey").cast("string"), 8, "0")
    steps = [
        {"customer": fn.add(F.lit("C"), digits), "state": fn.if_("o_orderstatus", "eq", "F", "closed", "open")},
        {"code": fn.add("customer", F.lit("/"), "o_orderstatus")},
        {"pending": fn.contains("code", "/P")},
    ]
    return stages(orders, steps).select("o_orderkey", "code", "state", "pending")
