"""The column functions, each over a whole table."""

from pyspark.sql import functions as F

from tabloom import functions as fn
from tabloom.operators import stage
from tabloom.queries.registry import query, table


def _outputs(df, key, outputs):
    """The key columns and the outputs of one stage."""
    return stage(df, outputs).select(*key, *outputs)


@query("expr_passthrough", "select c_custkey, c_name as name, 'customer' as kind, c_acctbal as balance from customer")
def passthrough(spark, sf):
    outputs = {"name": fn.value("c_name"), "kind": F.lit("customer"), "balance": "c_acctbal"}
    return _outputs(table(spark, sf, "customer"), ["c_custkey"], outputs)


@query(
    "expr_concat",
    """select event_id, event_type || '-' || json_extract_string(props, '$.k') || '/null' as joined,
              cast(null as varchar) as from_null from events""",
)
def concat(spark, sf):
    k, missing = (F.get_json_object("props", f"$.{n}") for n in ("k", "zz"))
    outputs = {
        "joined": fn.add("event_type", F.lit("-"), k, F.lit("/"), missing),
        "from_null": fn.add(missing, "event_type"),
    }
    return _outputs(table(spark, sf, "events"), ["event_id"], outputs)


@query(
    "expr_add_int",
    """select p_partkey, cast((cast(p_size as bigint) + 2147483620 + 2147483648) % 4294967296 - 2147483648
                              as integer) as total from part""",
)
def add_int(spark, sf):
    return _outputs(table(spark, sf, "part"), ["p_partkey"], {"total": fn.add("p_size", F.lit(2147483620))})


@query(
    "expr_add_float",
    """select p_partkey, cast(cast(p_retailprice as float) + cast(p_size as float) as double) as total
       from part""",
)
def add_float(spark, sf):
    price, size = F.col("p_retailprice").cast("float"), F.col("p_size").cast("float")
    total = _outputs(table(spark, sf, "part"), ["p_partkey"], {"total": fn.add(price, size)})
    return total.withColumn("total", F.col("total").cast("double"))


@query("expr_add_long", "select l_orderkey, l_partkey + l_suppkey + l_orderkey as total from lineitem")
def add_long(spark, sf):
    outputs = {"total": fn.add("l_partkey", "l_suppkey", "l_orderkey")}
    return _outputs(table(spark, sf, "lineitem"), ["l_orderkey"], outputs)


@query(
    "expr_add_mixed",
    """select l_orderkey, l_linenumber + l_partkey as int_first, l_partkey + l_linenumber + 2 as long_first
       from lineitem""",
)
def add_mixed(spark, sf):
    """Whole numbers of different width."""
    outputs = {
        "int_first": fn.add("l_linenumber", "l_partkey"),
        "long_first": fn.add("l_partkey", "l_linenumber", F.lit(2)),
    }
    return _outputs(table(spark, sf, "lineitem"), ["l_orderkey"], outputs)


@query(
    "expr_nested",
    """select l_orderkey, lpad(cast(l_linenumber * 10 as varchar), 5, '0') as padded,
              strftime(date_trunc('second', l_shipdate), '%d.%m.%Y') as day
       from lineitem""",
)
def nested(spark, sf):
    """Functions of functions, four deep: each is worked out once."""
    number = fn.to_int(fn.rjust(fn.to_str(fn.to_int(F.concat(F.col("l_linenumber").cast("string"), F.lit("0")))), 3))
    text = F.date_format("l_shipdate", "yyyyMMdd HHmmss")
    millis = fn.strptime(fn.strftime(fn.strptime(text, "yyyyMMdd HHmmss"), "yyyy-MM-dd HH:mm"), "yyyy-MM-dd HH:mm")
    outputs = {"padded": fn.rjust(number, 5), "day": fn.strftime(millis, "dd.MM.yyyy")}
    return _outputs(table(spark, sf, "lineitem"), ["l_orderkey"], outputs)


@query("expr_add_double", "select l_orderkey, l_extendedprice + l_quantity + l_tax as total from lineitem")
def add_double(spark, sf):
    outputs = {"total": fn.add("l_extendedprice", "l_quantity", "l_tax")}
    return _outputs(table(spark, sf, "lineitem"), ["l_orderkey"], outputs)


@query(
    "expr_str",
    """select c_custkey, cast(c_custkey as varchar) as of_long, cast(c_nationkey as varchar) as of_int,
              cast(c_acctbal as varchar) as of_double, c_name as of_text,
              coalesce(nullif(c_mktsegment, 'BUILDING'), '') as of_null, '' as of_boolean
       from customer""",
)
def to_str(spark, sf):
    outputs = {
        "of_long": fn.to_str("c_custkey"),
        "of_int": fn.to_str("c_nationkey"),
        "of_double": fn.to_str("c_acctbal"),
        "of_text": fn.to_str("c_name"),
        "of_null": fn.to_str(F.nullif("c_mktsegment", F.lit("BUILDING"))),
        "of_boolean": fn.to_str(F.col("c_acctbal") > 0),
    }
    return _outputs(table(spark, sf, "customer"), ["c_custkey"], outputs)


@query(
    "expr_int",
    """select o_orderkey, cast(substr(o_orderpriority, 1, 1) as integer) as of_text,
              coalesce(cast(case when o_orderstatus <> 'F' then '17' end as integer), 0) as of_null,
              cast(o_custkey as integer) as of_long, 0 as of_wide_long, 0 as of_double
       from orders""",
)
def to_int(spark, sf):
    outputs = {
        "of_text": fn.to_int(F.substring("o_orderpriority", 1, 1)),
        "of_null": fn.to_int(F.when(F.col("o_orderstatus") != "F", F.lit("17"))),
        "of_long": fn.to_int("o_custkey"),
        "of_wide_long": fn.to_int(F.col("o_custkey") + F.lit(3_000_000_000)),
        "of_double": fn.to_int("o_totalprice"),
    }
    return _outputs(table(spark, sf, "orders"), ["o_orderkey"], outputs)


_RJUST = """case when length(format('{{:,}}', {0})) < {1} then lpad(format('{{:,}}', {0}), {1}, '0')
                 else format('{{:,}}', {0}) end"""


@query(
    "expr_rjust",
    f"""select p_partkey, {_RJUST.format('p_size', 6)} as of_int, {_RJUST.format('p_partkey', 4)} as of_long,
               {_RJUST.format('p_partkey * 100', 3)} as of_text, cast(p_retailprice as varchar) as of_double,
               case when p_size <> 7 then {_RJUST.format('p_size', 2)} end as of_null
        from part""",
)
def rjust(spark, sf):
    outputs = {
        "of_int": fn.rjust("p_size", 6),
        "of_long": fn.rjust("p_partkey", 4),
        "of_text": fn.rjust((F.col("p_partkey") * 100).cast("string"), 3),
        "of_double": fn.rjust("p_retailprice", 5),
        "of_null": fn.rjust(F.nullif("p_size", F.lit(7)), 2),
    }
    return _outputs(table(spark, sf, "part"), ["p_partkey"], outputs)


def _instant(column):
    """A zone-less timestamp read as UTC, whatever the session zone."""
    return F.concat(F.col(column).cast("string"), F.lit("Z")).cast("timestamp")


@query(
    "expr_strftime",
    """select event_id,
              strftime(date_trunc('second', ts) + interval 8 hour, '%Y-%m-%d %H:%M:%S') as of_seconds,
              strftime(ts + interval 8 hour, '%Y/%m/%d %H:%M:%S.%g') as of_millis
       from events""",
)
def strftime(spark, sf):
    seconds, millis = (f(_instant("ts")).cast("string") for f in (F.unix_seconds, F.unix_millis))
    outputs = {
        "of_seconds": fn.strftime(seconds, "yyyy-MM-dd HH:mm:ss"),
        "of_millis": fn.strftime(millis, "yyyy/MM/dd HH:mm:ss.SSS"),
    }
    return _outputs(table(spark, sf, "events"), ["event_id"], outputs)


@query(
    "expr_strptime",
    """select o_orderkey, cast(epoch_us(o_orderdate) // 1000 - 28800000 as varchar) as millis from orders""",
)
def strptime(spark, sf):
    day = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    return _outputs(table(spark, sf, "orders"), ["o_orderkey"], {"millis": fn.strptime(day, "yyyy-MM-dd")})


@query(
    "expr_dateformat",
    """select o_orderkey, strftime(o_orderdate, '%Y%m%d') as day, strftime(o_orderdate, '%d/%m/%Y 00:00') as minute,
              '' as of_bad_text
       from orders""",
)
def dateformat(spark, sf):
    day = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    outputs = {
        "day": fn.reformat_date(day, "yyyy-MM-dd", "yyyyMMdd"),
        "minute": fn.reformat_date(day, "yyyy-MM-dd", "dd/MM/yyyy HH:mm"),
        "of_bad_text": fn.reformat_date("o_orderpriority", "yyyy-MM-dd", "yyyyMMdd"),
    }
    return _outputs(table(spark, sf, "orders"), ["o_orderkey"], outputs)


_OPERATORS = {"eq": "=", "ne": "<>", "lt": "<", "le": "<=", "gt": ">", "ge": ">="}


def _compare(method, sign):
    """``if_`` with one method on numbers, text, missing values and a pattern that is no number."""

    oracle = f"""select p_partkey,
                        case when p_size {sign} 25 then 'yes' else 'no' end as on_int,
                        case when p_retailprice {sign} 950.5 then 'yes' else 'no' end as on_double,
                        case when p_brand {sign} 'Brand#2' then 'yes' else 'no' end as on_text,
                        case when nullif(p_type, 'SMALL') {sign} 'LARGE' then 'yes' else 'no' end as on_null,
                        'no' as on_no_number
                 from part"""

    def run(spark, sf):
        outputs = {
            "on_int": fn.if_("p_size", method, "25", "yes", "no"),
            "on_double": fn.if_("p_retailprice", method, "950.5", "yes", "no"),
            "on_text": fn.if_("p_brand", method, "Brand#2", "yes", "no"),
            "on_null": fn.if_(F.nullif("p_type", F.lit("SMALL")), method, "LARGE", "yes", "no"),
            "on_no_number": fn.if_("p_size", method, "many", "yes", "no"),
        }
        return _outputs(table(spark, sf, "part"), ["p_partkey"], outputs)

    query(f"expr_if_{method}", oracle)(run)


for _method, _sign in _OPERATORS.items():
    _compare(_method, _sign)


@query(
    "expr_if_contains",
    """select doc_id, case when contains(text, 'the ') then 'yes' else 'no' end as on_text,
              case when contains(cast(n_chars as varchar), '7') then 'yes' else 'no' end as on_number
       from documents""",
)
def if_contains(spark, sf):
    outputs = {
        "on_text": fn.if_("text", "contains", "the ", "yes", "no"),
        "on_number": fn.if_("n_chars", "contains", "7", "yes", "no"),
    }
    return _outputs(table(spark, sf, "documents"), ["doc_id"], outputs)


@query(
    "expr_if_null_result",
    """select c_custkey, case when c_acctbal < 0 then null else c_name end as solvent,
              case when c_mktsegment = 'BUILDING' then 'builder' end as builder
       from customer""",
)
def if_null_result(spark, sf):
    outputs = {
        "solvent": fn.if_("c_acctbal", "lt", "0", "NULL", F.col("c_name")),
        "builder": fn.if_("c_mktsegment", "eq", "BUILDING", "builder", "NULL"),
    }
    return _outputs(table(spark, sf, "customer"), ["c_custkey"], outputs)


@query(
    "expr_contains",
    """select p_partkey, case when contains(p_name, 'ring') then 1 else 0 end as has_ring,
              coalesce(case when contains(nullif(p_type, 'SMALL'), 'ECO') then 1 else 0 end, 0) as has_eco
       from part""",
)
def contains(spark, sf):
    outputs = {
        "has_ring": fn.contains("p_name", "ring"),
        "has_eco": fn.contains(F.nullif("p_type", F.lit("SMALL")), "ECO"),
    }
    return _outputs(table(spark, sf, "part"), ["p_partkey"], outputs)
