"""Special characters, placement, whitespace, empty values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.registry import Tables, money, query, sql_clean, sql_place, sql_trim
from rinse.functions import text
from rinse.operators import profile
from rinse.plans.config import PLACEMENT_MODES, CurationConfig, PlacementRule


@query("clean_customer_name", f"""
    select c_custkey, {sql_clean('c_name')} as c_name from customer""")
def clean_customer_name(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", text.clean(F.col("c_name")).alias("c_name"))


@query("clean_page_html", f"""
    select page_id, {sql_clean('html')} as html from pages""")
def clean_page_html(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.clean(F.col("html")).alias("html"))


@query("clean_document_text", f"""
    select doc_id, {sql_clean('text')} as text from documents""")
def clean_document_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.clean(F.col("text")).alias("text"))


@query("clean_extra_allowed", f"""
    select p_partkey, {sql_clean("'#' || p_brand || '!*'", "#")} as p_brand from part""")
def clean_extra_allowed(t: Tables) -> DataFrame:
    decorated = F.concat(F.lit("#"), "p_brand", F.lit("!*"))
    return t.part.select("p_partkey", text.clean(decorated, extra="#").alias("p_brand"))


@query("clean_accents", f"""
    select doc_id, {sql_clean('text', 'éèêçàñóíäöüß')} as text from documents""")
def clean_accents(t: Tables) -> DataFrame:
    config = CurationConfig(extra_allowed="éèêçàñóíäöüß")
    return t.documents.select("doc_id", text.clean(F.col("text"), config.extra_allowed).alias("text"))


MARKED_SQL = "'#$' || l_returnflag || '$ ' || l_linenumber || '$#'"


def _marked() -> F.Column:
    return F.concat(
        F.lit("#$"), "l_returnflag", F.lit("$ "), F.col("l_linenumber").cast("string"), F.lit("$#")
    )


def _place(mode: int | None) -> None:
    lead, middle, trail = PLACEMENT_MODES[mode]
    rule = PlacementRule.of("$", [mode, "marked"] if mode else ["marked"])
    sql = f"""
        select l_orderkey, l_linenumber, marked,
               {sql_place('marked', '$', lead, middle, trail)} as placed
        from (select l_orderkey, l_linenumber, {MARKED_SQL} as marked from lineitem)"""

    @query(f"place_{mode or 'both'}", sql)
    def place(t: Tables) -> DataFrame:
        rows = t.lineitem.select("l_orderkey", "l_linenumber", _marked().alias("marked"))
        return rows.withColumn("placed", text.clean(F.col("marked"), rule=rule))


for _mode in PLACEMENT_MODES:
    _place(_mode)


SIGNED_SQL = "case when c_acctbal < 0 then '' else '+' end || cast(c_acctbal as decimal(12,2))::varchar || '+-'"


@query("place_multi", f"""
    select c_custkey, {sql_place('signed', '+/-', True, True, False)} as balance
    from (select c_custkey, {SIGNED_SQL} as signed from customer)""")
def place_multi(t: Tables) -> DataFrame:
    sign = F.when(F.col("c_acctbal") < 0, "").otherwise("+")
    signed = F.concat(sign, money("c_acctbal"), F.lit("+-"))
    rule = PlacementRule.of("+/-", [4, "balance"])
    rows = t.customer.select("c_custkey", signed.alias("balance"))
    return rows.withColumn("balance", text.clean(F.col("balance"), rule=rule))


def _violations_sql() -> str:
    parts = [
        f"""select 'mode_{mode or 'both'}' as "column", count(marked) as non_null,
                   count(*) filter (where marked <> {sql_place('marked', '$', *places)}) as rows
            from marked_items"""
        for mode, places in PLACEMENT_MODES.items()
    ]
    body = " union all ".join(parts)
    return f"with marked_items as (select {MARKED_SQL} as marked from lineitem) {body}"


@query("placement_violations", _violations_sql())
def placement_violations(t: Tables) -> DataFrame:
    names = {mode: f"mode_{mode or 'both'}" for mode in PLACEMENT_MODES}
    rules = tuple(
        PlacementRule.of("$", [mode, name] if mode else [name]) for mode, name in names.items()
    )
    rows = t.lineitem.select([_marked().alias(name) for name in names.values()])
    return profile.special_characters(rows, CurationConfig(placement=rules))


PADDED_SQL = "case when p_size > 25 then ' ' || p_name || chr(9) else p_name end"


def _padded() -> F.Column:
    padded = F.concat(F.lit(" "), "p_name", F.lit("\t"))
    return F.when(F.col("p_size") > 25, padded).otherwise(F.col("p_name"))


@query("trim_values", f"""
    select p_partkey, {sql_trim(PADDED_SQL)} as p_name from part""")
def trim_values(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.trim_space(_padded()).alias("p_name"))


@query("space_profile", rf"""
    select 'p_name' as "column", count(p) as non_null,
           count(*) filter (where regexp_matches(p, '^\s+|\s+$')) as rows
    from (select {PADDED_SQL} as p from part)
    union all
    select 'p_brand', count(p_brand), count(*) filter (where regexp_matches(p_brand, '^\s+|\s+$'))
    from part""")
def space_profile(t: Tables) -> DataFrame:
    rows = t.part.select(_padded().alias("p_name"), "p_brand")
    return profile.count_where(rows, text.has_outer_space)


def _special_sql(*sources: tuple[str, str]) -> str:
    return " union all ".join(
        f"""select '{name}' as "column", count({name}) as non_null,
                   count(*) filter (where {name} <> {sql_clean(name)}) as rows
            from {table}"""
        for table, name in sources
    )


@query("special_profile", _special_sql(
    ("documents", "text"), ("documents", "lang"), ("pages", "url"), ("pages", "html"),
    ("part", "p_name"), ("part", "p_brand")))
def special_profile(t: Tables) -> DataFrame:
    config = CurationConfig()
    return (
        profile.special_characters(t.documents, config, ["text", "lang"])
        .unionByName(profile.special_characters(t.pages, config, ["url", "html"]))
        .unionByName(profile.special_characters(t.part, config, ["p_name", "p_brand"]))
    )


@query("special_profile_extra", f"""
    select 'p_brand' as "column", count(p_brand) as non_null,
           count(*) filter (where p_brand <> {sql_clean("p_brand", "#")}) as rows
    from part""")
def special_profile_extra(t: Tables) -> DataFrame:
    return profile.special_characters(t.part, CurationConfig(extra_allowed="#"), ["p_brand"])


STATUS_SQL = "case when o_orderstatus = 'P' then '' else o_orderstatus end"


def _status() -> F.Column:
    return F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus"))


@query("empty_to_null", f"""
    select o_orderkey, nullif({STATUS_SQL}, '') as o_orderstatus from orders""")
def empty_to_null(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", text.empty_to_null(_status()).alias("o_orderstatus"))


@query("empty_profile", f"""
    select 'o_orderstatus' as "column", count(s) as non_null, count(*) filter (where s = '') as rows
    from (select {STATUS_SQL} as s from orders)
    union all
    select 'o_orderpriority', count(o_orderpriority), count(*) filter (where o_orderpriority = '')
    from orders""")
def empty_profile(t: Tables) -> DataFrame:
    rows = t.orders.select(_status().alias("o_orderstatus"), "o_orderpriority")
    return profile.count_where(rows, text.is_empty)
