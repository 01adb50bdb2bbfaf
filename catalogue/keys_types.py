"""Type inference, key checks, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogue.registry import Tables, as_text, money, query
from rinse.functions import numeric
from rinse.operators import keys, profile

# Columns of lineitem as text, with what makes each of them interesting.
LINE_TEXT_SQL = """
    select l_orderkey, l_linenumber,
           l_partkey::varchar as part,
           cast(l_extendedprice as decimal(12,2))::varchar as price,
           case when l_linenumber = 1 then l_suppkey::varchar
                else cast(l_quantity as decimal(12,2))::varchar end as mixed,
           '999' || l_partkey || '00000000' as overflow,
           '-' || l_linenumber as negative,
           case when l_linenumber < 8 then null else '1' end as nothing,
           case when l_returnflag = 'R' then null else l_linenumber::varchar end as gaps
    from lineitem"""
LINE_TEXT = ("part", "price", "mixed", "overflow", "negative", "nothing", "gaps")


def _line_text(t: Tables) -> DataFrame:
    def text(name: str) -> Column:
        return F.col(name).cast("string")

    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        text("l_partkey").alias("part"),
        money("l_extendedprice").alias("price"),
        F.when(F.col("l_linenumber") == 1, text("l_suppkey"))
        .otherwise(money("l_quantity"))
        .alias("mixed"),
        F.concat(F.lit("999"), text("l_partkey"), F.lit("00000000")).alias("overflow"),
        F.concat(F.lit("-"), text("l_linenumber")).alias("negative"),
        F.when(F.col("l_linenumber") < 8, None).otherwise("1").alias("nothing"),
        F.when(F.col("l_returnflag") == "R", None).otherwise(text("l_linenumber")).alias("gaps"),
    )


def _infer_sql() -> str:
    counts = " union all ".join(
        rf"""select '{name}' as "column", count({name}) as non_null,
                   count(*) filter (where regexp_matches({name}, '^[0-9]*\.[0-9]*$')
                                      and try_cast({name} as float) is not null) as float_rows,
                   count(*) filter (where regexp_matches({name}, '^[0-9]+$')
                                      and try_cast({name} as integer) is not null) as integer_rows
            from line_text"""
        for name in LINE_TEXT
    )
    return f"""
        with line_text as ({LINE_TEXT_SQL}), counts as ({counts})
        select *, case when non_null > 0 and float_rows = non_null then 'float'
                       when non_null > 0 and integer_rows = non_null then 'integer'
                       else 'string' end as type
        from counts"""


@query("infer_types", _infer_sql())
def infer_types(t: Tables) -> DataFrame:
    return profile.infer_types(_line_text(t).select(*LINE_TEXT))


# Floats leave as doubles, which compare exactly between engines.
@query("cast_types", f"""
    select l_orderkey, l_linenumber, try_cast(part as integer) as part,
           try_cast(price as float)::double as price, try_cast(overflow as integer) as overflow,
           try_cast(gaps as integer) as gaps
    from ({LINE_TEXT_SQL})""")
def cast_types(t: Tables) -> DataFrame:
    return _line_text(t).select(
        "l_orderkey",
        "l_linenumber",
        numeric.to_integer(F.col("part")).alias("part"),
        numeric.to_float(F.col("price")).cast("double").alias("price"),
        numeric.to_integer(F.col("overflow")).alias("overflow"),
        numeric.to_integer(F.col("gaps")).alias("gaps"),
    )


KEYED_SQL = """select case when o_orderpriority = '1-URGENT' then null else o_orderkey end as o_orderkey,
                      case when o_orderstatus = 'P' then null else o_custkey end as o_custkey
               from orders"""


def _keyed(t: Tables) -> DataFrame:
    return t.orders.select(
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderkey")).alias("o_orderkey"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"),
    )


@query("pk_check", f"""
    with counts as (select count(*) filter (where o_orderkey is null) as pk from ({KEYED_SQL}))
    select 'primary' as key, case when pk > 0 then 'not valid' else 'valid' end as status,
           pk as invalid_rows, pk as rows_with_null from counts
    union all select 'composite', 'not given', 0, 0""")
def pk_check(t: Tables) -> DataFrame:
    return keys.check_keys(_keyed(t), primary_key="o_orderkey")


@query("ck_check", f"""
    with counts as (
        select count(*) filter (where concat(o_orderkey::varchar, o_custkey::varchar) = '') as ck,
               count(*) filter (where o_orderkey is null or o_custkey is null) as gaps
        from ({KEYED_SQL}))
    select 'primary' as key, 'not given' as status, 0::bigint as invalid_rows, 0::bigint as rows_with_null
    union all
    select 'composite', case when ck > 0 then 'not valid' else 'valid' end, ck, gaps from counts""")
def ck_check(t: Tables) -> DataFrame:
    return keys.check_keys(_keyed(t), composite_keys=["o_orderkey", "o_custkey"])


LINE_REST = (
    "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)


@query("dedup_pk", f"""
    select * exclude (place) from (
        select *, row_number() over (partition by l_orderkey order by {LINE_REST}) as place
        from lineitem)
    where place = 1""")
def dedup_pk(t: Tables) -> DataFrame:
    return keys.deduplicate(t.lineitem, ["l_orderkey"], order_by=["l_linenumber"])


@query("dedup_composite", f"""
    select * exclude (place) from (
        select *, row_number() over (
            partition by l_orderkey, l_linenumber
            order by l_shipdate, {LINE_REST.removeprefix("l_linenumber, ").removesuffix(", l_shipdate")}) as place
        from lineitem)
    where place = 1""")
def dedup_composite(t: Tables) -> DataFrame:
    return keys.deduplicate(t.lineitem, ["l_orderkey", "l_linenumber"], order_by=["l_shipdate"])


@query("dedup_row", "select distinct * replace (doc_id % 50 as doc_id) from documents")
def dedup_row(t: Tables) -> DataFrame:
    """Whole rows; the ids repeat, so that copies of a text can be equal rows."""
    rows = t.documents.withColumn("doc_id", F.col("doc_id") % 50)
    return keys.deduplicate(rows, keys.dedup_keys(rows.columns))


# Every customer without a market segment of their own shares one NULL key.
@query("dedup_null_key", """
    select c.* replace (case when c_acctbal < 0 then c_mktsegment end as c_mktsegment)
    from customer c
    where c_custkey in (select min(c_custkey) from customer group by case when c_acctbal < 0 then c_mktsegment end)""")
def dedup_null_key(t: Tables) -> DataFrame:
    segment = F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment"))
    return keys.deduplicate(t.customer.withColumn("c_mktsegment", segment), ["c_mktsegment"])


@query("dedup_report", """
    select 'documents' as source, count(*) as rows_before, count(distinct text) as rows_after,
           count(*) - count(distinct text) as removed from documents
    union all
    select 'lineitem', count(*), (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)),
           count(*) - (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem))
    from lineitem""")
def dedup_report(t: Tables) -> DataFrame:
    documents = keys.count_duplicates(t.documents, ["text"])
    lines = keys.count_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])
    return documents.select(F.lit("documents").alias("source"), "*").unionByName(
        lines.select(F.lit("lineitem").alias("source"), "*")
    )


@query("dedup_map", """
    select user_id, min(event_id) as event_id, arg_min(regexp_extract(props, '[0-9]+')::int, event_id) as k
    from events group by user_id""")
def dedup_map(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_id", F.from_json("props", "map<string,int>").alias("props"))
    kept = keys.deduplicate(rows, ["user_id"], ["event_id"])
    return kept.select("user_id", "event_id", F.element_at("props", "k").alias("k"))


@query("dedup_whole_row", """
    select * exclude (props), regexp_extract(props, '[0-9]+')::int as k from events""")
def dedup_whole_row(t: Tables) -> DataFrame:
    rows = t.events.withColumn("props", F.from_json("props", "map<string,int>"))
    copies = rows.unionByName(rows.where("event_id % 3 = 0"))
    kept = keys.deduplicate(copies, copies.columns)
    return kept.withColumn("k", F.element_at("props", "k")).drop("props")
