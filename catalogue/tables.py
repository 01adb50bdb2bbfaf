"""Headers, reports, reading and writing, and curation from end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import Tables, as_text, money, query, sql_clean, sql_place, sql_text, sql_trim
from rinse.operators import headers, report
from rinse.operators.profile import profile
from rinse.plans import plan as planning
from rinse.plans.config import CurationConfig
from rinse.plans.curate import curate, curate_data, learn
from rinse.plans.plan import CurationPlan
from rinse.sources import readers, writers
from rinse.sources.scratch import scratch_folder


def _messy(t: Tables) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return t.customer.select(
        F.col("c_custkey").alias("CUST Key"),
        F.col("c_name").alias("  Full  Name "),
        F.col("c_nationkey").alias("Nation (%)"),
        nothing.alias("_c3"),
        F.col("c_mktsegment").alias("_c4"),
        F.col("c_acctbal").alias("x!"),
        F.col("c_acctbal").alias("x"),
    )


@query("header_normalise", """
    select c_custkey as cust_key, c_name as full_name, c_nationkey as nation_,
           null::varchar as unnamed_3, c_mktsegment as unnamed_4, c_acctbal as x, c_acctbal as x_2
    from customer""")
def header_normalise(t: Tables) -> DataFrame:
    messy = _messy(t)
    return headers.rename(messy, headers.resolve(messy.columns))


@query("header_report", """
    select *, (select count(*) from customer) as row_count from (values
        (0, 'CUST Key', 'cust_key', true, true, false, false, null),
        (1, '  Full  Name ', 'full_name', true, true, false, false, null),
        (2, 'Nation (%)', 'nation_', true, true, true, false, null),
        (3, '_c3', 'unnamed_3', false, false, false, true, 0),
        (4, '_c4', 'unnamed_4', false, false, false, true, (select count(c_mktsegment) from customer)),
        (5, 'x!', 'x', false, false, true, false, null),
        (6, 'x', 'x_2', false, false, false, false, null)
    ) as h(position, source, name, has_uppercase, has_space, has_special, is_missing, non_null)""")
def header_report(t: Tables) -> DataFrame:
    return headers.header_report(_messy(t))


@query("unnamed_columns", """
    select c_custkey as cust_key, c_name as full_name, c_nationkey as nation_,
           c_mktsegment as unnamed_4, c_acctbal as x, c_acctbal as x_2
    from customer""")
def unnamed_columns(t: Tables) -> DataFrame:
    return headers.name_columns(_messy(t))


@query("dataset_report", """
    select position, "column", type, (select count(*) from lineitem) as row_count, 11 as column_count
    from (values (0, 'l_orderkey', 'bigint'), (1, 'l_partkey', 'bigint'), (2, 'l_suppkey', 'bigint'),
                 (3, 'l_linenumber', 'int'), (4, 'l_quantity', 'double'), (5, 'l_extendedprice', 'double'),
                 (6, 'l_discount', 'double'), (7, 'l_tax', 'double'), (8, 'l_returnflag', 'string'),
                 (9, 'l_linestatus', 'string'), (10, 'l_shipdate', 'timestamp_ntz')
         ) as c(position, "column", type)""")
def dataset_report(t: Tables) -> DataFrame:
    return report.dataset_report(t.lineitem)


@query("table_statistics", """
    select 'orders' as source, count(*) as row_count, 6 as column_count from orders
    union all select 'documents', count(*), 5 from documents""")
def table_statistics(t: Tables) -> DataFrame:
    return report.statistics(t.orders).select(F.lit("orders").alias("source"), "*").unionByName(
        report.statistics(t.documents).select(F.lit("documents").alias("source"), "*")
    )


@query("preview", "select * from orders order by o_orderkey limit 10")
def preview(t: Tables) -> DataFrame:
    return report.preview(t.orders, 10, order_by=["o_orderkey"])


@query("inspect_column", "select event_type from events")
def inspect_column(t: Tables) -> DataFrame:
    return report.inspect(t.events, "event_type")


@query("parquet_roundtrip", "select * from orders")
def parquet_roundtrip(t: Tables) -> DataFrame:
    path = scratch_folder(t.spark, "catalogue")
    writers.write_parquet(t.orders, path)
    return t.spark.read.parquet(path)


@query("csv_roundtrip", """
    select o_orderkey::varchar as o_orderkey, o_custkey::varchar as o_custkey,
           ' ' || o_orderstatus || ' ' as o_orderstatus,
           cast(o_totalprice as decimal(12,2))::varchar as o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, o_orderpriority || ', "so"' as o_orderpriority
    from orders""")
def csv_roundtrip(t: Tables) -> DataFrame:
    path = scratch_folder(t.spark, "catalogue")
    rows = t.orders.withColumns(
        {
            "o_totalprice": money("o_totalprice"),
            "o_orderstatus": F.concat(F.lit(" "), "o_orderstatus", F.lit(" ")),
            "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd"),
            "o_orderpriority": F.concat("o_orderpriority", F.lit(', "so"')),
        }
    )
    writers.write_csv(rows, path)
    return readers.read_csv(t.spark, path)


# Customers as a badly kept CSV would hold them: padded names with a stray mark,
# amounts with a currency sign at both ends, gaps, and every row of one segment twice.
DIRTY_CUSTOMER_SQL = """
    select c_custkey::varchar as "CUST Key", ' ' || c_name || '! ' as "Name",
           c_nationkey::varchar as "Nation (%)",
           '$' || cast(abs(c_acctbal) as decimal(12,2))::varchar || '$' as "Balance",
           case when c_mktsegment = 'MACHINERY' then '--' else c_mktsegment end as "Segment"
    from customer
    union all
    select c_custkey::varchar, ' ' || c_name || '! ', c_nationkey::varchar,
           '$' || cast(abs(c_acctbal) as decimal(12,2))::varchar || '$', '--'
    from customer where c_mktsegment = 'MACHINERY'"""


def _dirty_customer(t: Tables) -> DataFrame:
    segment = F.when(F.col("c_mktsegment") == "MACHINERY", "--").otherwise(F.col("c_mktsegment"))
    balance = F.abs("c_acctbal").cast("decimal(12,2)").cast("string")
    rows = t.customer.select(
        F.col("c_custkey").cast("string").alias("CUST Key"),
        F.concat(F.lit(" "), "c_name", F.lit("! ")).alias("Name"),
        F.col("c_nationkey").cast("string").alias("Nation (%)"),
        F.concat(F.lit("$"), balance, F.lit("$")).alias("Balance"),
        segment.alias("Segment"),
        F.lit(None).cast("string").alias("_c5"),
    )
    return rows.unionByName(rows.filter(F.col("Segment") == "--"))


CUSTOMER_CONFIG = CurationConfig.of(
    primary_key="CUST Key", composite_keys=["Name", "Segment"], valid_spl_chars={"$": [1, "Balance"]}
)
CURATED_CUSTOMER_SQL = f"""
    select distinct {sql_text('"CUST Key"')}::integer as cust_key, {sql_text('"Name"')} as name,
           {sql_text('"Nation (%)"')}::integer as nation_,
           nullif({sql_place(sql_trim('"Balance"'), '$', True, False, False)}, '') as balance,
           {sql_text('"Segment"')} as segment
    from ({DIRTY_CUSTOMER_SQL})"""


@query("curate_customer", CURATED_CUSTOMER_SQL)
def curate_customer(t: Tables) -> DataFrame:
    return curate(_dirty_customer(t), CUSTOMER_CONFIG).df


@query("curate_customer_written", CURATED_CUSTOMER_SQL)
def curate_customer_written(t: Tables) -> DataFrame:
    return curate(_dirty_customer(t), CUSTOMER_CONFIG, output_folder=scratch_folder(t.spark, "catalogue")).df


@query("curate_customer_csv", CURATED_CUSTOMER_SQL)
def curate_customer_csv(t: Tables) -> DataFrame:
    """The same table by way of CSV files, with the configuration of the path-based call."""
    path = scratch_folder(t.spark, "catalogue")
    writers.write_csv(_dirty_customer(t), path)
    return curate_data(
        path,
        primary_key="CUST Key",
        composite_keys=["Name", "Segment"],
        valid_spl_chars={"$": [1, "Balance"]},
        inputtz="GMT",
        outputtz="America/New_York",
        spark=t.spark,
    ).df


CURATED_ORDERS_CSV_SQL = """
    select o_orderkey::varchar as o_orderkey, o_custkey::varchar as o_custkey, o_orderstatus,
           cast(o_totalprice as decimal(12,2))::varchar as o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, o_orderpriority
    from orders"""


def _orders_text(t: Tables) -> DataFrame:
    return t.orders.select(
        *as_text("o_orderkey", "o_custkey"),
        "o_orderstatus",
        money("o_totalprice").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        "o_orderpriority",
    )


@query("csv_orders_of_columns", CURATED_ORDERS_CSV_SQL)
def csv_orders_of_columns(t: Tables) -> DataFrame:
    """One table of many files, in which the columns stand in three different orders."""
    path, rows = scratch_folder(t.spark, "catalogue"), _orders_text(t)
    names = rows.columns
    for k, order in enumerate((names, names[::-1], names[2:] + names[:2])):
        writers.write_csv(rows.where(F.col("o_orderkey").cast("bigint") % 3 == k).select(*order), f"{path}/part={k}")
    return readers.read_csv(t.spark, f"{path}/*")


# Every seventh order has a field too many, every seventh one too few.
_BROKEN = "case o_orderkey % 7 when 0 then o_orderkey || ',' || o_custkey || ',\"a, b\",' || o_orderstatus when 1 then o_orderkey || ',' || o_custkey else o_orderkey || ',' || o_custkey || ',\"' || o_orderstatus || ', x\"' end"


def _broken_csv(t: Tables) -> str:
    """A folder of CSV files as a faulty writer leaves them: lines with their own quotes."""
    path = scratch_folder(t.spark, "catalogue")
    lines = t.orders.select(F.expr(_BROKEN).alias("Order Key,Customer,Status"))
    lines.write.options(header=True, quote="", escapeQuotes=False, sep="\x01").csv(path)
    return path


@query("curate_malformed", """
    select o_orderkey::integer as order_key, o_custkey::integer as customer,
           case when o_orderkey % 7 != 1 then o_orderstatus || ', x' end as status
    from orders where o_orderkey % 7 != 0""")
def curate_malformed(t: Tables) -> DataFrame:
    return curate_data(_broken_csv(t), primary_key="Order Key", spark=t.spark).df


@query("malformed_rows", f"""
    select o_orderkey::varchar as "Order Key", o_custkey::varchar as "Customer", 'a, b' as "Status", {_BROKEN} as line
    from orders where o_orderkey % 7 = 0""")
def malformed_rows(t: Tables) -> DataFrame:
    """What curation kept apart: the fields as far as they go, and the line."""
    apart = curate_data(_broken_csv(t), primary_key="Order Key", spark=t.spark).malformed
    return apart.withColumnRenamed(readers.MALFORMED, "line")


@query("audit_malformed", """
    select rule, rows_affected from (values
        ('malformed', (select count(*) from orders where o_orderkey % 7 = 0)),
        ('short', (select count(*) from orders where o_orderkey % 7 = 1)),
        ('integer', (select count(*) from orders where o_orderkey % 7 != 0)),
        ('duplicates', 0)
    ) as a(rule, rows_affected)""")
def audit_malformed(t: Tables) -> DataFrame:
    audit = curate_data(_broken_csv(t), primary_key="Order Key", spark=t.spark).audit
    return audit.where("rule in ('malformed', 'short', 'duplicates') or `column` = 'order_key' and rule = 'integer'").select(
        "rule", "rows_affected"
    )


@query("csv_one_file", CURATED_ORDERS_CSV_SQL)
def csv_one_file(t: Tables) -> DataFrame:
    """One headered file, written by many tasks."""
    path = scratch_folder(t.spark, "catalogue") + "/orders.csv"
    writers.write_csv_file(_orders_text(t).repartition(7), path)
    return readers.read_csv(t.spark, path)


@query("raw_preview", CURATED_ORDERS_CSV_SQL + " order by orders.o_orderkey limit 10")
def raw_preview(t: Tables) -> DataFrame:
    """The first rows of a raw file, as they are."""
    path = scratch_folder(t.spark, "catalogue") + "/orders.csv"
    writers.write_csv_file(_orders_text(t).orderBy(F.col("o_orderkey").cast("bigint")), path)
    return readers.preview_csv(t.spark, path, 10)


# Two columns that are ISO already, and two that need repair.
@query("curate_iso", """
    select event_id::integer as event_id, ts::date as day, date_trunc('second', ts) as moment,
           ts::date as day_first, date_trunc('millisecond', ts) as spoken
    from events""")
def curate_iso(t: Tables) -> DataFrame:
    return curate(_iso_events(t), CurationConfig(primary_key="event_id")).df


def _iso_events(t: Tables) -> DataFrame:
    return t.events.select(
        *as_text("event_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("moment"),
        F.date_format("ts", "dd/MM/yyyy").alias("day first"),
        F.date_format("ts", "'at 'yyyy/MM/dd HH:mm:ss.SSSSSS").alias("spoken"),
    )


@query("audit_iso", """
    select rule, "column", rows_affected from (values
        ('date', 'day_first', (select count(*) from events)), ('timestamp', 'spoken', (select count(*) from events)),
        ('integer', 'event_id', (select count(*) from events)), ('space', 'spoken', (select count(*) from events)),
        ('space', 'day_first', null)
    ) as a(rule, "column", rows_affected)""")
def audit_iso(t: Tables) -> DataFrame:
    """Columns that are ISO already are not among the repaired ones."""
    audit = curate(_iso_events(t), CurationConfig(primary_key="event_id")).audit
    return audit.where("`column` is not null and rule not in ('primary key', 'duplicates')").select("rule", "column", "rows_affected")


def _store(t: Tables, scheme: str, authority: str) -> SparkSession:
    """A session of its own for which the store ``scheme://authority`` is a folder that all executors share."""
    session = t.spark.newSession()
    for key, value in {
        f"fs.{scheme}.impl": "org.apache.hadoop.fs.viewfs.ViewFileSystemOverloadScheme",
        f"fs.{scheme}.impl.disable.cache": "true",
        f"fs.viewfs.overload.scheme.target.{scheme}.impl": "org.apache.hadoop.fs.viewfs.ViewFileSystem",
        # The factory that Hadoop names for S3 is not part of Spark's own distribution.
        f"mapreduce.outputcommitter.factory.scheme.{scheme}": "org.apache.hadoop.mapreduce.lib.output.FileOutputCommitterFactory",
        f"fs.viewfs.mounttable.{authority}.linkFallback": _uri(scratch_folder(t.spark, "catalogue")),
        "spark.sql.session.timeZone": t.spark.conf.get("spark.sql.session.timeZone"),
    }.items():
        session.conf.set(key, value)
    return session


def _uri(folder: str) -> str:
    return folder if "://" in folder else "file://" + folder.removeprefix("file:")


def _curated_in_store(t: Tables, session: SparkSession, uri: str, path: str, **storage: dict[str, str]) -> DataFrame:
    """Dirty customers, written to the store as CSV, curated by their path, and read back from the store."""
    writers.write_csv(_dirty_customer(Tables(session, t.folder)), uri)
    result = curate_data(
        path,
        output_file_path=uri.removesuffix("/in") + "/out",
        logging_path=uri.removesuffix("/in") + "/log",
        primary_key="CUST Key",
        composite_keys=["Name", "Segment"],
        valid_spl_chars={"$": [1, "Balance"]},
        spark=session,
        **storage,
    )
    return result.df


@query("curate_customer_s3", CURATED_CUSTOMER_SQL)
def curate_customer_s3(t: Tables) -> DataFrame:
    keys = {"access_key": "id", "secret_key": "hidden"}
    return _curated_in_store(t, _store(t, "s3a", "bucket"), "s3a://bucket/in", "s3://bucket/in", aws_s3=keys)


@query("curate_customer_azure", CURATED_CUSTOMER_SQL)
def curate_customer_azure(t: Tables) -> DataFrame:
    blob = {"storage_account_name": "acc", "storage_account_key": "hidden", "container_name": "box"}
    authority = "box@acc.blob.core.windows.net"
    session = _store(t, "wasbs", authority)
    return _curated_in_store(t, session, f"wasbs://{authority}/in", "in", azure_blob=blob)


@query("audit_written", """
    select "Cleansing Part", "Message" from (values
        ('Data', 'column ''balance'': misplaced characters removed in ' || (select count(*) from customer) || ' rows'),
        ('Data', 'primary key ''id'': valid'), ('Data', 'composite key: not given'), ('Data', '0 duplicates removed'),
        ('Header', 'Header: no cleansing required')
    ) as v("Cleansing Part", "Message")""")
def audit_written(t: Tables) -> DataFrame:
    """The audit as the CSV that curation writes."""
    balance = F.concat(F.lit("$x"), money("c_acctbal"), F.lit("x$")).alias("balance")
    rows = t.customer.select(F.col("c_custkey").alias("id"), balance)
    config = CurationConfig.of(primary_key="id", valid_spl_chars={"$": [1, "balance"]})
    log = curate(rows, config, log_folder=scratch_folder(t.spark, "catalogue")).log_path
    return readers.read_csv(t.spark, log).select("Cleansing Part", "Message")


@query("apply_saved_plan_later", """
    select l_orderkey, l_linenumber,
           case when l_linenumber <= 3 then l_partkey::integer end as part,
           case when l_linenumber <= 3 then 0.5::double end as share
    from lineitem""")
def apply_saved_plan_later(t: Tables) -> DataFrame:
    """A plan learned from numbers, applied to a batch that also holds what is no number."""
    number = F.col("l_linenumber")
    part = F.col("l_partkey").cast("string")
    good = t.lineitem.select("l_orderkey", "l_linenumber", part.alias("part"), F.lit("1.5").alias("share"))
    saved = learn(good, CurationConfig()).plan
    later = good.select(
        "l_orderkey",
        "l_linenumber",
        F.when(number <= 3, F.col("part")).when(number == 4, "99999999999").otherwise("x1").alias("part"),
        F.when(number <= 3, "0.5").when(number == 4, "7d").when(number == 5, "nan").otherwise("1e3").alias("share"),
    )
    return planning.apply(later, saved).withColumn("share", F.col("share").cast("double"))


@query("apply_saved_plan", f"""
    select {sql_text('"CUST Key"')}::integer as cust_key, {sql_text('"Name"')} as name,
           {sql_text('"Nation (%)"')}::integer as nation_,
           nullif({sql_place(sql_trim('"Balance"'), '$', True, False, False)}, '') as balance,
           {sql_text('"Segment"')} as segment
    from ({DIRTY_CUSTOMER_SQL})""")
def apply_saved_plan(t: Tables) -> DataFrame:
    saved = learn(_dirty_customer(t), CUSTOMER_CONFIG).plan.to_json()
    return planning.apply(_dirty_customer(t), CurationPlan.from_json(saved))


@query("curate_orders", """
    select o_orderkey::integer as o_orderkey, o_custkey::integer as o_custkey,
           nullif(o_orderstatus, 'P') as o_orderstatus,
           cast(o_totalprice as decimal(12,2))::varchar::float::double as o_totalprice,
           o_orderdate::date as o_orderdate, o_orderpriority
    from orders""")
def curate_orders(t: Tables) -> DataFrame:
    result = curate(_dirty_orders(t), CurationConfig(primary_key="o_orderkey"))
    return result.df.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


def _dirty_orders(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "P", "#").otherwise(F.col("o_orderstatus"))
    return t.orders.select(
        *as_text("o_orderkey", "o_custkey"),
        status.alias("o_orderstatus"),
        money("o_totalprice").alias("o_totalprice"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("o_orderdate"),
        F.concat("o_orderpriority", F.lit("\t")).alias("o_orderpriority"),
    )


@query("curate_events", """
    select event_id::integer as event_id,
           date_trunc('millisecond', timezone('America/New_York', timezone('UTC', ts))) as ts,
           user_id::integer as user_id, event_type, value, 'k: ' || regexp_extract(props, '[0-9]+') as props
    from events""")
def curate_events(t: Tables) -> DataFrame:
    rows = t.events.select(
        *as_text("event_id", "user_id"),
        F.date_format("ts", "'at 'yyyy/MM/dd HH:mm:ss.SSSSSS").alias("ts"),
        F.concat(F.lit("<"), "event_type", F.lit(">")).alias("event_type"),
        "value",
        "props",
    )
    config = CurationConfig.of(primary_key="event_id", outputtz="America/New_York")
    return curate(rows, config).df


@query("audit_log", """
    with n as (select count(*) as every, count(*) filter (where o_orderstatus = 'P') as p,
                      count(*) - count(distinct o_orderkey) as twice from orders)
    select "Cleansing Part", "Message", rule, "column", rows_affected from (
        select unnest([
            {'Cleansing Part': 'Header', 'Message': 'Header: no cleansing required', 'rule': 'none', 'column': null, 'rows_affected': null},
            {'Cleansing Part': 'Data', 'Message': format('column ''o_orderstatus'': special characters removed in {} rows', p),
             'rule': 'special', 'column': 'o_orderstatus', 'rows_affected': p},
            {'Cleansing Part': 'Data', 'Message': format('column ''o_orderstatus'': empty values set to NULL in {} rows', p),
             'rule': 'missing', 'column': 'o_orderstatus', 'rows_affected': p},
            {'Cleansing Part': 'Data', 'Message': format('column ''o_orderpriority'': outer spaces removed in {} rows', every),
             'rule': 'space', 'column': 'o_orderpriority', 'rows_affected': every},
            {'Cleansing Part': 'Data', 'Message': format('column ''o_orderdate'': dates made ISO in {} rows', every),
             'rule': 'date', 'column': 'o_orderdate', 'rows_affected': every},
            {'Cleansing Part': 'Data', 'Message': format('column ''o_orderkey'': text made integer in {} rows', every),
             'rule': 'integer', 'column': 'o_orderkey', 'rows_affected': every},
            {'Cleansing Part': 'Data', 'Message': format('column ''o_custkey'': text made integer in {} rows', every),
             'rule': 'integer', 'column': 'o_custkey', 'rows_affected': every},
            {'Cleansing Part': 'Data', 'Message': format('column ''o_totalprice'': text made float in {} rows', every),
             'rule': 'float', 'column': 'o_totalprice', 'rows_affected': every},
            {'Cleansing Part': 'Data', 'Message': 'primary key ''o_orderkey'': valid', 'rule': 'primary key', 'column': 'o_orderkey', 'rows_affected': 0},
            {'Cleansing Part': 'Data', 'Message': 'composite key: not given', 'rule': 'composite key', 'column': null, 'rows_affected': null},
            {'Cleansing Part': 'Data', 'Message': format('{} duplicates removed', twice),
             'rule': 'duplicates', 'column': 'o_orderkey', 'rows_affected': twice}
        ], recursive := true) from n)""")
def audit_log(t: Tables) -> DataFrame:
    return curate(_dirty_orders(t), CurationConfig(primary_key="o_orderkey")).audit.drop("Timestamp")


@query("profile_customer", rf"""
    with dirty as (select *, null::varchar as nothing from ({DIRTY_CUSTOMER_SQL})), long as (
        {" union all ".join(
            f'''select '{new}' as "column", {old} as v, {sql_trim(old)} as t, {clean} as k from dirty'''
            for new, old, clean in (
                ("cust_key", '"CUST Key"', sql_clean(sql_trim('"CUST Key"'))),
                ("name", '"Name"', sql_clean(sql_trim('"Name"'))),
                ("nation_", '"Nation (%)"', sql_clean(sql_trim('"Nation (%)"'))),
                ("balance", '"Balance"', sql_place(sql_trim('"Balance"'), "$", True, False, False)),
                ("segment", '"Segment"', sql_clean(sql_trim('"Segment"'))),
                ("unnamed_5", "nothing", "nothing"),
            ))})
    select "column", count(*) as rows, count(v) as non_null,
           count(*) filter (where t <> v) as padded_rows, count(*) filter (where k <> t) as special_rows,
           count(*) filter (where k = '') as empty_rows, count(nullif(k, '')) as filled_rows,
           count(*) filter (where regexp_matches(k, '^[0-9]*\.[0-9]*$') and try_cast(k as float) is not null) as float_rows,
           count(*) filter (where regexp_matches(k, '^[0-9]+$') and try_cast(k as integer) is not null) as integer_rows,
           count(*) filter (where regexp_matches(v, '^.*[0-9]+[/-][0-9]+[/-][0-9]+')) as date_rows,
           count(*) filter (where contains(v, ':')) as timestamp_rows,
           count(*) filter (where regexp_matches(v, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')) as iso_date_rows,
           count(*) filter (where regexp_matches(v, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ][0-9:]+$')) as iso_timestamp_rows,
           count(*) filter (where contains(v, ':')) as zoned_rows
    from long group by "column" """)
def profile_customer(t: Tables) -> DataFrame:
    dirty = _dirty_customer(t)
    names = headers.resolve(dirty.columns)
    config = CurationConfig.of(valid_spl_chars={"$": [1, "balance"]})
    return profile(headers.rename(dirty, names), config)
