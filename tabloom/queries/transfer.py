"""Sources, sinks and the flow between them.

Round trips write below the session's shared folder, each run to a path of its own.
"""

import uuid

from pyspark.sql import functions as F

from tabloom.durable import new_folder
from tabloom.operators import cells_to_wide, stage, wide_to_cells
from tabloom.operators.cell_table import CellTable
from tabloom.plans import Flow, generated_select
from tabloom.queries.registry import query, table
from tabloom.session import settings
from tabloom.sinks import publish_orc, read_published, register_orc_table, write_cells, write_orc
from tabloom.sources import read_partition

_ORDER_SCHEMA = [
    "orderkey;long",
    "custkey;long",
    "priority;string",
    "totalprice;double",
    "year;int",
    "month;int",
]


def _orders_by_month(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice", F.year("o_orderdate"), F.month("o_orderdate")
    )


def _written_orders(spark, sf):
    path = new_folder(spark, "orders")
    write_orc(_orders_by_month(spark, sf), path, _ORDER_SCHEMA, ["year", "month"], gather=True)
    return path


@query(
    "src_partition_scan",
    """select o_orderkey as orderkey, o_totalprice as totalprice, year(o_orderdate) as year,
              month(o_orderdate) as month from orders where year(o_orderdate) = 1997""",
)
def partition_scan(spark, sf):
    path = _written_orders(spark, sf)
    scan = read_partition(spark, path, f"{path}/year=1997")
    return scan.select("orderkey", "totalprice", F.col("year").cast("bigint"), F.col("month").cast("bigint"))


@query(
    "src_unfinished_partition",
    """select o_orderkey as orderkey, o_orderpriority as priority from orders where year(o_orderdate) = 1996""",
)
def unfinished_partition(spark, sf):
    """One year is there, of the next one a job has written no more than its working files."""
    path = _written_orders(spark, sf)
    under_way = f"{path}/year=2100"
    _orders_by_month(spark, sf).limit(5).write.orc(f"{under_way}/_temporary/0/_temporary/attempt_0")
    schema = ["orderkey;long", "priority;string"]
    flow = (
        Flow(spark)
        .partition_source("there", path, f"{path}/year=1996", schema)
        .partition_source("not_yet", path, under_way, schema)
        .result("select * from there")
        .result("select * from not_yet")
    )
    return flow.union()


@query(
    "flow_width_and_persist",
    """select o_custkey as custkey, count(*) as orders, 1 as copy, true as kept, 3 as tasks from orders group by 1
       union all select o_custkey, count(*), 2, true, 3 from orders group by 1""",
)
def flow_width_and_persist(spark, sf):
    """A table that is cached for two results, under a flow's own shuffle width."""
    path = new_folder(spark, "counts")
    with Flow(spark, shuffle_partitions=3) as flow:
        flow.source("flow_orders", table(spark, sf, "orders").select("o_custkey"))
        flow.table("flow_counts", "select o_custkey, count(*) as n from flow_orders group by o_custkey", persist=True)
        kept = str(spark.table("flow_counts").storageLevel.useMemory).lower()
        for copy in (1, 2):
            flow.result(f"select o_custkey, n, {copy}, {kept} from flow_counts distribute by o_custkey")
        schema = ["custkey;long", "orders;long", "copy;int", "kept;boolean"]
        with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
            flow.save(lambda df: write_orc(df, path, schema, mode="append"))
            with flow.settings():
                width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read_partition(spark, path).withColumn("tasks", F.lit(width))


@query(
    "sink_width_roundtrip",
    "select s_suppkey as suppkey, s_name as name, true as few_files from supplier",
)
def width_roundtrip(spark, sf):
    """Written by two tasks after a shuffle."""
    path = new_folder(spark, "suppliers")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    write_orc(suppliers.repartition(8), path, ["suppkey;long", "name;string"], partitions=2, shuffle=True)
    back = read_partition(spark, path)
    return back.withColumn("few_files", F.lit(len(back.inputFiles()) <= 2))


@query("src_empty_fallback", "select o_custkey as custkey, count(*) as orders from orders group by o_custkey")
def empty_fallback(spark, sf):
    """A day that was not delivered: its table is empty and the SQL over both still runs."""
    schema = ["custkey;long", "priority;string"]
    flow = (
        Flow(spark)
        .partition_source("late_orders", new_folder(spark, "absent"), new_folder(spark, "absent"), schema)
        .source(
            "known_orders",
            stage(table(spark, sf, "orders"), {"custkey": "o_custkey", "priority": "o_orderpriority"}),
            schema=schema,
        )
        .result(
            """select custkey, count(*) as orders
               from (select * from known_orders union all select * from late_orders) group by custkey"""
        )
    )
    return flow.union()


def _customer_cells(spark, sf):
    """Customers as stored cells: each value twice, an outdated version and the current one."""
    versions = F.explode(F.array(F.lit(1), F.lit(2))).alias("version")
    customer = table(spark, sf, "customer").select("*", versions)
    value = {
        "name": F.col("c_name"),
        "segment": F.col("c_mktsegment"),
        "nation": F.col("c_nationkey").cast("string"),
        "remark": F.lit("not asked for"),
    }
    cells = F.array(*(F.struct(F.lit(q).alias("qualifier"), v.alias("value")) for q, v in value.items()))
    current = F.when(F.col("version") == 2, F.col("cell.value")).otherwise(F.lit("zz outdated"))
    return (
        customer.select("c_custkey", "version", F.explode(cells).alias("cell"))
        .where("cell.value is not null")
        .select(
            F.col("c_custkey").cast("string").alias("rowkey"),
            F.lit("d").alias("family"),
            F.col("cell.qualifier").alias("qualifier"),
            current.cast("binary").alias("value"),
            "version",
        )
    )


@query(
    "cells_to_wide",
    """select cast(c_custkey as varchar) as rowkey, c_name as "d:name", c_mktsegment as "d:segment",
              cast(c_nationkey as varchar) as "d:nation", cast(null as varchar) as "d:phone" from customer""",
)
def cells_wide(spark, sf):
    names = ["d:name", "d:segment", "d:nation", "d:phone"]
    return cells_to_wide(_customer_cells(spark, sf), names, version="version")


@query(
    "cells_declared",
    """select cast(c_custkey as varchar) as rowkey, c_mktsegment as "d:segment" from customer
       where c_mktsegment <> 'BUILDING'""",
)
def cells_declared(spark, sf):
    """Only rows that have a declared cell, read without the other cells."""
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string"), "c_name", F.nullif("c_mktsegment", F.lit("BUILDING"))
    )
    cells = wide_to_cells(customer, ["id;string", "name;string", "segment;string"], row="id", family="d")
    return cells_to_wide(cells, ["d:segment"], keep_empty=False)


@query(
    "wide_to_cells",
    """with c as (select hex(encode(c_name)) as rowkey, * from customer)
       select rowkey, 'd' as family, 'name' as qualifier, hex(encode(c_name)) as value from c
       union all select rowkey, 'd', 'segment', hex(encode(c_mktsegment)) from c where c_mktsegment <> 'BUILDING'
       union all select rowkey, 'd', 'nation', lpad(to_hex(c_nationkey), 8, '0') from c
       union all select rowkey, 'd', 'custkey', lpad(to_hex(c_custkey), 16, '0') from c""",
)
def wide_cells(spark, sf):
    wide = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")), "c_nationkey"
    )
    schema = ["custkey;long", "name;string", "segment;string", "nation;int"]
    cells = wide_to_cells(wide, schema, row="name", family="d")
    return cells.select(F.hex("rowkey").alias("rowkey"), "family", "qualifier", F.hex("value").alias("value"))


@query(
    "cells_encode",
    """with p as (select lpad(to_hex(p_partkey), 16, '0') as rowkey, *,
                         cast(floor(log2(p_retailprice)) as bigint) as e from part)
       select rowkey, 'partkey' as qualifier, rowkey as value from p
       union all select rowkey, 'size', lpad(to_hex(p_size), 8, '0') from p
       union all select rowkey, 'debt', to_hex(18446744073709551616::hugeint - p_partkey - 1) from p
       union all select rowkey, 'large', case when p_size > 25 then 'FF' else '00' end from p
       union all select rowkey, 'price', to_hex((e + 1023) * 4503599627370496
                        + cast((p_retailprice / pow(2, e) - 1) * 4503599627370496 as bigint)) from p
       union all select rowkey, 'rough', to_hex((e + 127) * 8388608
                        + cast((cast(cast(p_retailprice as float) as double) / pow(2, e) - 1) * 8388608 as bigint))
                 from p
       union all select rowkey, 'made', hex(encode('{"brand":"' || p_brand || '"}')) from p""",
)
def cells_encode(spark, sf):
    """Every encoded type; negative long values are two's complement."""
    part = table(spark, sf, "part").select(
        "p_partkey",
        "p_size",
        (-F.col("p_partkey") - 1).alias("debt"),
        F.col("p_size") > 25,
        "p_retailprice",
        F.col("p_retailprice").cast("float"),
        F.struct(F.col("p_brand").alias("brand")),
    )
    # Types are the table's own; the schema gives names.
    names = ["partkey;long", "size;int", "debt;long", "large;boolean", "price;double", "rough;float", "made;string"]
    cells = wide_to_cells(part, names, row="partkey", family="d")
    return cells.select(F.hex("rowkey").alias("rowkey"), "qualifier", F.hex("value").alias("value"))


@query(
    "sql_named_table",
    """select segment, count(*) as customers, cast(sum(orders) as bigint) as orders
       from (select c_mktsegment as segment, c_custkey, count(*) as orders
             from customer join orders on o_custkey = c_custkey group by c_mktsegment, c_custkey)
       where orders > 5 group by segment""",
)
def named_table(spark, sf):
    flow = (
        Flow(spark)
        .source("customer_input", table(spark, sf, "customer"))
        .source("order_input", table(spark, sf, "orders"))
        .table(
            "order_count",
            "select o_custkey, count(*) as orders from order_input group by o_custkey having count(*) > 5",
        )
        .result(
            """select c_mktsegment as segment, count(*) as customers, sum(orders) as orders
               from customer_input join order_count on o_custkey = c_custkey group by c_mktsegment"""
        )
    )
    return flow.union()


@query(
    "sql_named_repartition",
    """select o_custkey, count(*) as orders, max(o_orderkey) as newest from orders group by o_custkey""",
)
def named_repartition(spark, sf):
    flow = (
        Flow(spark)
        .source("order_input", table(spark, sf, "orders"))
        .table("order_by_customer", "select o_custkey, o_orderkey from order_input", partition_by="o_custkey")
        .result(
            """select o_custkey, count(*) as orders, max(o_orderkey) as newest
               from order_by_customer group by o_custkey"""
        )
    )
    return flow.union()


@query("sql_preview", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 20")
def preview(spark, sf):
    flow = Flow(spark).source("order_input", table(spark, sf, "orders"))
    return flow.preview(
        "select o_orderkey, o_totalprice from order_input order by o_totalprice desc, o_orderkey", show=False
    )


@query(
    "sql_generated_select",
    """select '0' as f0, cast(c_custkey as varchar) as f1, n_name as f2, '3' as f3, c_mktsegment as f4
       from customer inner join nation on c_nationkey = n_nationkey
       where (c_acctbal > 0 and n_regionkey <> 1) or c_mktsegment <> 'BUILDING'""",
)
def select_by_schema(spark, sf):
    Flow(spark).source(
        "customer_input", table(spark, sf, "customer").withColumnRenamed("c_mktsegment", "f4")
    ).source("nation_input", table(spark, sf, "nation"))
    return generated_select(
        spark,
        ["f0;string;'0'", "f1;string;'1'", "f2;string", "f3;string;'3'", "f4;string"],
        {"f1": "cast(c_custkey as string)", "f2": "n.n_name", "ignored": "1"},
        "customer_input c inner join nation_input n on c.c_nationkey = n.n_nationkey",
        "(c_acctbal > 0 and n_regionkey <> 1) or f4 <> 'BUILDING'",
    )


@query(
    "sql_union_all",
    """select c_name as name, c_nationkey as nation from customer
       union all select s_name, s_nationkey from supplier union all select n_name, n_nationkey from nation""",
)
def union_results(spark, sf):
    flow = Flow(spark)
    for name in ("customer", "supplier", "nation"):
        flow.source(f"{name}_input", table(spark, sf, name))
    flow.result("select c_name as name, c_nationkey as nation from customer_input")
    flow.result_select(["name;string", "nation;int"], {"name": "s_name", "nation": "s_nationkey"}, "supplier_input")
    flow.result("select n_name, n_nationkey from nation_input")
    return flow.union()


@query(
    "sink_orc_roundtrip",
    """select o_orderkey as orderkey, o_custkey as custkey, o_orderpriority as priority, o_totalprice as totalprice,
              year(o_orderdate) as year, month(o_orderdate) as month from orders""",
)
def orc_roundtrip(spark, sf):
    back = read_partition(spark, _written_orders(spark, sf))
    return back.select(
        "orderkey", "custkey", "priority", "totalprice", F.col("year").cast("bigint"), F.col("month").cast("bigint")
    )


@query(
    "sink_append_results",
    """select c_name as name, 'customer' as kind from customer union all select s_name, 'supplier' from supplier""",
)
def append_results(spark, sf):
    """Each result is saved by itself, to one dataset."""
    path = new_folder(spark, "names")
    flow = (
        Flow(spark)
        .source("customer_input", table(spark, sf, "customer"))
        .source("supplier_input", table(spark, sf, "supplier"))
        .result("select c_name, 'customer' from customer_input")
        .result("select s_name, 'supplier' from supplier_input")
    )
    flow.save(lambda df: write_orc(df, path, ["name;string", "kind;string"], ["kind"], mode="append"))
    return read_partition(spark, path)


@query(
    "sink_cells_roundtrip",
    """select c_name as rowkey, c_name as "d:name", cast(c_custkey as varchar) as "d:id", c_mktsegment as "d:segment"
       from customer""",
)
def cells_roundtrip(spark, sf):
    """Text columns written as stored cells and read back as wide rows."""
    path = new_folder(spark, "cells")
    text = table(spark, sf, "customer").select(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")
    write_cells(text, path, ["id;string", "name;string", "segment;string"], row="name", family="d")
    return cells_to_wide(read_partition(spark, path), ["d:name", "d:id", "d:segment"], version="version")


@query(
    "sink_register_table",
    """select cast(year(o_orderdate) as varchar) as year, count(*) as orders,
              sum(cast(round(o_totalprice * 100) as bigint)) / 100.0 as total from orders group by 1""",
)
def register_table(spark, sf):
    """The table is entered anew at every run, under one name."""
    path = _written_orders(spark, sf)
    spark.sql("drop table if exists tabloom_orders_by_month")
    orders = register_orc_table(spark, "tabloom_orders_by_month", path, _ORDER_SCHEMA, ["year", "month"])
    cents = F.sum(F.round(F.col("totalprice") * 100).cast("bigint"))
    return orders.groupBy("year").agg(F.count(F.lit(1)).alias("orders"), (cents / F.lit(100.0)).alias("total"))


@query(
    "sink_publish_rerun",
    """select cast(count(*) as bigint) as copies, l as id, k as kind from (
           select c_custkey as l, 'customer' as k from customer union all select s_suppkey, 'supplier' from supplier) t
       group by l, k""",
)
def publish_rerun(spark, sf):
    """A job that saves two results to one dataset, run twice: each row is there once."""
    path = new_folder(spark, "published")
    schema = ["id;long", "kind;string"]
    for _ in range(2):
        flow = (
            Flow(spark)
            .source("customer_input", table(spark, sf, "customer"))
            .source("supplier_input", table(spark, sf, "supplier"))
            .result("select c_custkey, 'customer' from customer_input")
            .result("select s_suppkey, 'supplier' from supplier_input")
        )
        writers = iter(("customers", "suppliers"))
        flow.save(lambda df, names=writers: publish_orc(df, path, schema, ["kind"], writer=next(names)))
    return read_published(spark, path).groupBy("id", "kind").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "sink_publish_partitions",
    """select o_orderkey as orderkey, year(o_orderdate) as year,
              case when year(o_orderdate) = 1995 then 0.0 else o_totalprice end as totalprice from orders""",
)
def publish_partitions(spark, sf):
    """Orders by year, of which one year is written again; the others stay as they are."""
    path = new_folder(spark, "published")
    schema = ["orderkey;long", "totalprice;double", "year;int"]
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    publish_orc(orders, path, schema, ["year"], gather=True)
    publish_orc(orders.where("year = 1995").withColumn("o_totalprice", F.lit(0.0)), path, schema, ["year"])
    return read_published(spark, path)


@query(
    "cells_three_writes",
    """select c_name as rowkey, cast(c_custkey as varchar) as "d:id", case when c_custkey % 3 = 0 then null
              else cast(c_nationkey as varchar) end as "d:nation",
              case when c_custkey % 2 = 0 then 'MOVED' else c_mktsegment end as "d:segment" from customer""",
)
def cells_three_writes(spark, sf):
    """A cell table that is written three times, cells anew each time, and read as wide rows without a shuffle."""
    kept = CellTable(spark, f"cells_{uuid.uuid4().hex}", new_folder(spark, "cell-table"), buckets=8)
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("string").alias("nation"),
    )
    as_cells = lambda df, columns: wide_to_cells(df.select(*columns), [f"{c};string" for c in columns], "name", "d")
    kept.write(as_cells(customers, ["id", "name", "segment"]))
    kept.write(as_cells(customers.where("id % 2 = 0").withColumn("segment", F.lit("MOVED")), ["name", "segment"]))
    kept.write(as_cells(customers.where("id % 3 <> 0"), ["name", "nation"]))
    found = kept.wide(["d:id", "d:nation", "d:segment"])
    kept.forget()
    return found
