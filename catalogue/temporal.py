"""Dates and timestamps in text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogue.registry import Tables, query
from rinse.functions import temporal
from rinse.operators import profile
from rinse.plans import plan as planning
from rinse.plans.plan import ColumnPlan, CurationPlan

# Which rows get which format, by a column that has nothing to do with the date.
KIND = "o_orderkey % 3"


def _mixed(first: str, second: str, third: str) -> Column:
    kind = F.col("o_orderkey") % 3
    return (
        F.when(kind == 0, F.date_format("o_orderdate", first))
        .when(kind == 1, F.date_format("o_orderdate", second))
        .otherwise(F.date_format("o_orderdate", third))
    )


def _mixed_sql(first: str, second: str, third: str) -> str:
    return f"""case {KIND} when 0 then strftime(o_orderdate, '{first}')
                           when 1 then strftime(o_orderdate, '{second}')
                           else strftime(o_orderdate, '{third}') end"""


STRIP_DATE = r"regexp_replace(d, '[^0-9/\-]', '', 'g')"


def _cascade_sql(mixed: str, *formats: str) -> str:
    tries = ", ".join(f"try_strptime(s, '{f}')" for f in formats)
    return f"""
        select o_orderkey, coalesce({tries})::date as o_orderdate
        from (select o_orderkey, {STRIP_DATE} as s from (select o_orderkey, {mixed} as d from orders))"""


def _iso(t: Tables, mixed: Column) -> DataFrame:
    return t.orders.select(
        "o_orderkey", temporal.iso_date(temporal.strip_date(mixed)).alias("o_orderdate")
    )


@query("date_iso_slash", _cascade_sql(
    _mixed_sql("%d/%m/%Y", "%m/%d/%Y ", "on %-d/%-m/%Y"), "%d/%m/%Y", "%m/%d/%Y"))
def date_iso_slash(t: Tables) -> DataFrame:
    return _iso(t, _mixed("dd/MM/yyyy", "MM/dd/yyyy ", "'on 'd/M/yyyy"))


@query("date_iso_dash", _cascade_sql(
    _mixed_sql("%d-%m-%Y", "%m-%d-%Y ", "on %-d-%-m-%Y"), "%m-%d-%Y", "%d-%m-%Y"))
def date_iso_dash(t: Tables) -> DataFrame:
    return _iso(t, _mixed("dd-MM-yyyy", "MM-dd-yyyy ", "'on 'd-M-yyyy"))


@query("date_iso_ymd", _cascade_sql(
    _mixed_sql("%Y/%m/%d", "%Y-%d-%m", "%Y/%d/%m"),
    "%Y/%m/%d", "%Y/%d/%m", "%Y-%m-%d", "%Y-%d-%m"))
def date_iso_ymd(t: Tables) -> DataFrame:
    return _iso(t, _mixed("yyyy/MM/dd", "yyyy-dd-MM", "yyyy/dd/MM"))


def _date_like(value: str) -> str:
    """Three runs of digits between slashes or dashes: one of four, two of one or two."""
    runs = f"string_split(replace({value}, '-', '/'), '/')"
    digits = "len(list_filter(p, lambda x: len(x) > 0 and length(translate(x, '0123456789', '')) = 0)) = 3"
    sizes = "list_sort(list_transform(p, lambda x: length(x)))"
    return f"list_transform([{runs}], lambda p: len(p) = 3 and {digits} and {sizes} in ([1, 1, 4], [1, 2, 4], [2, 2, 4]))[1]"


def _timestamp_like(value: str) -> str:
    """A date and a time of day somewhere in the text, by the shape with each digit as 9."""
    return f"contains(translate({value}, '012345678-T', '999999999/ '), '9999/99/99 99:99:99')"


def _detect_sql(*sources: tuple[str, str]) -> str:
    def keep(name: str) -> str:
        return rf"regexp_replace({name}, '[^\x07-z]', '', 'g')"

    return " union all ".join(
        f"""select '{name}' as "column", count({name}) as non_null,
                   count(*) filter (where {_date_like(keep(name))}) as date_rows,
                   count(*) filter (where {_timestamp_like(keep(name))}) as timestamp_rows
            from {table}"""
        for table, name in sources
    )


@query("date_detect", _detect_sql(
    (f"""(select {_mixed_sql("%d/%m/%Y", "~%Y-%m-%d~", "on %-d/%Y/%-m")} as o_orderdate from orders)""",
     "o_orderdate"),
    ("orders", "o_orderpriority")))
def date_detect(t: Tables) -> DataFrame:
    dates = _mixed("dd/MM/yyyy", "'~'yyyy-MM-dd'~'", "'on 'd/yyyy/M")
    return profile.detect(t.orders.select(dates.alias("o_orderdate"), "o_orderpriority"))


@query("ts_detect", _detect_sql(
    ("(select strftime(ts, '%Y/%m/%dT%H:%M:%S') as ts from events)", "ts"),
    ("events", "event_type"), ("events", "props")))
def ts_detect(t: Tables) -> DataFrame:
    stamps = F.date_format("ts", "yyyy/MM/dd'T'HH:mm:ss").alias("ts")
    return profile.detect(t.events.select(stamps, "event_type", "props"))


# Every third text is a date or a timestamp among invented prose.
_PLANTED = """(select case doc_id % 6 when 0 then '12/' || (doc_id % 12 + 1) || '/2024' when 3 then text || ' on 2024-01-02T03:04:05'
                            else text end as text, source, lang from documents)"""


@query("detect_in_documents", _detect_sql((_PLANTED, "text"), (_PLANTED, "source"), (_PLANTED, "lang")))
def detect_in_documents(t: Tables) -> DataFrame:
    of = F.col("doc_id") % 6
    text = (
        F.when(of == 0, F.concat(F.lit("12/"), (F.col("doc_id") % 12 + 1).cast("string"), F.lit("/2024")))
        .when(of == 3, F.concat("text", F.lit(" on 2024-01-02T03:04:05")))
        .otherwise(F.col("text"))
    )
    return profile.detect(t.documents.select(text.alias("text"), "source", "lang"))


@query("iso_date_check", f"""
    select 'o_orderdate' as "column", count(d) as non_null,
           count(*) filter (where d is not null and not (
               regexp_matches(d, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') and try_strptime(d, '%Y-%m-%d') is not null
           )) as rows
    from (select {_mixed_sql("%Y-%m-%d", "%Y-%d-%m", "%d/%m/%Y")} as d from orders)""")
def iso_date_check(t: Tables) -> DataFrame:
    dates = _mixed("yyyy-MM-dd", "yyyy-dd-MM", "dd/MM/yyyy").alias("o_orderdate")
    return profile.count_where(t.orders.select(dates), lambda value: ~temporal.is_iso_date(value))


STAMP_SQL = """case event_id % 3 when 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'
                                 when 1 then 'at ' || strftime(ts, '%Y/%m/%d %H:%M:%S.%f')
                                 else strftime(ts, '%Y-%m-%d %H:%M:%S') || '+02:00' end"""


def _stamp() -> Column:
    kind = F.col("event_id") % 3
    return (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(kind == 1, F.date_format("ts", "'at 'yyyy/MM/dd HH:mm:ss.SSSSSS"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss'+02:00'"))
    )


@query("iso_ts_check", rf"""
    select 'ts' as "column", count(s) as non_null,
           count(*) filter (where s is not null and not (
               try_strptime(s, ['%Y-%m-%dT%H:%M:%S.%gZ', '%Y-%m-%d %H:%M:%S+02:00']) is not null)) as rows
    from (select case event_id % 10 when 0 then 'junk ' || strftime(ts, '%Y-%m-%d %H:%M:%S')
                                    when 1 then strftime(ts, '%Y-%m-%d %H:%M:%S') || ' junk'
                                    when 2 then '2024-99-99T99:99:99' else {STAMP_SQL} end as s from events)""")
def iso_ts_check(t: Tables) -> DataFrame:
    kind, plain = F.col("event_id") % 10, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    spoiled = (
        F.when(kind == 0, F.concat(F.lit("junk "), plain))
        .when(kind == 1, F.concat(plain, F.lit(" junk")))
        .when(kind == 2, F.lit("2024-99-99T99:99:99"))
        .otherwise(_stamp())
    )
    stamps = t.events.select(spoiled.alias("ts"))
    return profile.count_where(stamps, lambda value: ~temporal.is_iso_timestamp(value))


@query("ts_shift", f"""
    select event_id,
           date_trunc('millisecond', timezone('Asia/Tokyo', timezone(
               case event_id % 3 when 1 then 'America/New_York' else 'UTC' end,
               case event_id % 3 when 2 then date_trunc('second', ts) - interval 2 hour else ts end))) as ts
    from events""")
def ts_shift(t: Tables) -> DataFrame:
    stripped = temporal.strip_timestamp(_stamp())
    shifted = temporal.iso_timestamp(stripped, "America/New_York", "Asia/Tokyo")
    return t.events.select("event_id", shifted.alias("ts"))


@query("ts_iso_text", """
    select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' as ts from events""")
def ts_iso_text(t: Tables) -> DataFrame:
    return t.events.select("event_id", temporal.iso_text(F.col("ts")).alias("ts"))


@query("ts_typed_shift", """
    select * replace (timezone('America/New_York', timezone('UTC', ts)) as ts)
    from events""")
def ts_typed_shift(t: Tables) -> DataFrame:
    typed = CurationPlan(
        source_columns=tuple(t.events.columns),
        positions=tuple(range(len(t.events.columns))),
        columns=tuple(
            ColumnPlan(name, name, planning.TYPED_TIMESTAMP if name == "ts" else planning.UNTOUCHED)
            for name in t.events.columns
        ),
        output_tz="America/New_York",
    )
    return planning.apply(t.events, typed)


@query("typed_date_identity", "select * replace (l_shipdate::date as l_shipdate) from lineitem")
def typed_date_identity(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    plan = CurationPlan(
        source_columns=tuple(rows.columns),
        positions=tuple(range(len(rows.columns))),
        columns=tuple(ColumnPlan(name, name, planning.UNTOUCHED) for name in rows.columns),
    )
    return planning.apply(rows, plan)
