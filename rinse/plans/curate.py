"""End-to-end curation: profile, plan, apply, deduplicate, audit, write."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rinse.functions.expressions import column
from rinse.functions.temporal import same_zone
from rinse.operators import headers as header_rules
from rinse.operators import keys
from rinse.operators.audit import DATA, HEADER, Entry, audit_table
from rinse.operators.headers import Header
from rinse.operators.profile import COMPOSITE, MALFORMED, SHORT, kept_apart, profile, profile_temporal
from rinse.plans import plan as planning
from rinse.plans.config import CurationConfig
from rinse.plans.plan import CurationPlan
from rinse.sources import readers, writers
from rinse.sources.scratch import scratch_folder

Counts = dict[str, dict[str, int]]


@dataclass(frozen=True)
class CurationResult:
    df: DataFrame
    audit: DataFrame
    plan: CurationPlan
    output_path: str | None = None
    log_path: str | None = None
    #: Rows with more fields than the header: the fields as far as they go, and the whole line.
    malformed: DataFrame | None = None


def _by_column(findings: DataFrame) -> Counts:
    """A profile as plain data: as many rows as the table has columns."""
    return {row["column"]: row.asDict() for row in findings.collect()}


def _bind(config: CurationConfig, headers: Sequence[Header]) -> CurationConfig:
    """``config`` in terms of the new column names; old and new names both count."""
    bound = config.renamed({header.source: header.name for header in headers})
    known = {header.name for header in headers}
    unknown = sorted(set(bound.references()) - known)
    if unknown:
        raise ValueError(f"the configuration names columns that do not exist: {unknown}")
    return bound


@dataclass(frozen=True)
class Learned:
    """What a profile found: the plan made from it, the counts per new column name, the
    columns that stay, and the names of those that go for want of a name and a value."""

    plan: CurationPlan
    config: CurationConfig
    counts: Counts
    headers: list[Header]
    dropped: list[str]


def learn(
    df: DataFrame, config: CurationConfig | None = None, malformed: str | None = None
) -> Learned:
    """Profile ``df`` and plan its curation: one pass over the data, and a second one
    over the date and timestamp columns if there are any that are not ISO already.

    ``malformed`` names the CSV reader's column for rows that have not as many fields as the
    header, which must be the last one; rows with more fields are counted and left out of all else.
    """
    config = config or CurationConfig()
    sources = df.columns
    if malformed is not None:
        if not sources or sources[-1] != malformed:
            raise ValueError(f"{malformed!r} is not the last column")
        sources = sources[:-1]
    if not sources:
        raise ValueError("the file is empty")
    if header_rules.all_missing(sources):
        raise ValueError("all headers are empty")
    headers = header_rules.resolve(sources)
    renamed = header_rules.rename(df, headers, MALFORMED if malformed else None)
    bound = _bind(config, headers)
    counts = _by_column(profile(renamed, bound))
    if malformed is not None and counts:
        for name in counts.keys() - {MALFORMED, SHORT}:
            counts[name]["rows"] -= counts[MALFORMED]["non_null"]
    if not counts or all(row["rows"] == 0 for name, row in counts.items() if name not in (MALFORMED, SHORT)):
        raise ValueError("the file holds column names but no rows")
    if malformed is not None:
        renamed = renamed.where(~kept_apart()).drop(MALFORMED)

    empty = header_rules.empty_unnamed(
        headers, {name: row["non_null"] for name, row in counts.items()}
    )
    dropped = [header.name for header in headers if header.position in empty]
    referenced = sorted(set(dropped) & set(bound.references()))
    if referenced:
        raise ValueError(f"the configuration names columns without a header or value: {referenced}")
    headers = [header for header in headers if header.position not in empty]
    if not headers:
        raise ValueError("no column has a header or a value")
    renamed = renamed.drop(*dropped)
    plan = planning.make_plan(renamed, sources, headers, counts, bound)

    dates, timestamps = plan.to_repair(planning.DATE), plan.to_repair(planning.TIMESTAMP)
    if dates or timestamps:
        stale = set(plan.composite_keys) & {*dates, *timestamps}
        parts = [
            planning.curated(name, plan, renamed.schema) for name in plan.composite_keys if stale
        ]
        later = _by_column(profile_temporal(renamed, bound, dates, timestamps, parts))
        for name, row in later.items():
            counts[name] = counts[name] | row
    return Learned(plan, bound, counts, headers, dropped)


def _header_entries(headers: Sequence[Header], dropped: Sequence[str]) -> list[Entry]:
    def entries(rule: str, done: str, concerns: Sequence[Header]) -> list[Entry]:
        return [
            Entry(HEADER, rule, f"header {h.source!r}: {done}, now {h.name!r}", h.name)
            for h in concerns
        ]

    return [
        *entries("uppercase", "lower-cased", [h for h in headers if h.uppercase]),
        *entries("space", "spaces replaced by underscores", [h for h in headers if h.space]),
        *entries("special", "special characters removed", [h for h in headers if h.special]),
        *entries("unnamed", "missing name filled in", [h for h in headers if h.missing]),
        *entries("collision", "told apart from an equal name", [h for h in headers if h.renamed_apart]),
        *[
            Entry(HEADER, "dropped", f"column {name!r} has neither header nor values, dropped", name)
            for name in dropped
        ],
    ]


def _rows_entries(
    rule: str, done: str, names: Sequence[str], counts: Counts, counter: str, always: bool = False
) -> list[Entry]:
    return [
        Entry(DATA, rule, f"column {name!r}: {done} in {counts[name][counter]} rows", name,
              counts[name][counter])
        for name in names
        if always or counts[name][counter]
    ]


def _key_entries(plan: CurationPlan, counts: Counts) -> list[Entry]:
    entries = []
    key = plan.primary_key
    if key is None:
        entries.append(Entry(DATA, "primary key", "primary key: not given"))
    else:
        missing = counts[key]["rows"] - counts[key]["filled_rows"]
        status = f"not valid, {missing} rows without a value" if missing else "valid"
        entries.append(Entry(DATA, "primary key", f"primary key {key!r}: {status}", key, missing))
    if not plan.composite_keys:
        entries.append(Entry(DATA, "composite key", "composite key: not given"))
    else:
        row = counts[COMPOSITE]
        missing = row["rows"] - row["filled_rows"]
        status = f"not valid, all parts empty in {missing} rows" if missing else "valid"
        names = ", ".join(plan.composite_keys)
        entries.append(
            Entry(DATA, "composite key", f"composite key ({names}): {status}", names, missing)
        )
    return entries


def _data_entries(plan: CurationPlan, config: CurationConfig, counts: Counts) -> list[Entry]:
    texts = plan.of_kind(planning.TEXT, planning.INTEGER, planning.FLOAT)
    dates, timestamps = plan.to_repair(planning.DATE), plan.to_repair(planning.TIMESTAMP)
    placed = [p.name for p in plan.columns if p.rule]
    plain = [name for name in texts if name not in placed]
    iso_timestamps = [name for name in plan.of_kind(planning.TIMESTAMP) if name not in timestamps]
    overruled = [name for name in plan.of_kind(planning.DATE, planning.TIMESTAMP) if config.rule_for(name)]
    moved = f"brought from {plan.input_tz} to {plan.output_tz}"
    # Between equal zones, an ISO timestamp moves only if it carries its own.
    moving = "zoned_rows" if same_zone(plan.input_tz, plan.output_tz) else "non_null"
    malformed, short = (counts.get(name, {}).get("non_null", 0) for name in (MALFORMED, SHORT))
    return [
        *[
            Entry(DATA, "malformed", f"{malformed} rows with more fields than the header kept apart", None, malformed)
            for _ in range(malformed > 0)
        ],
        *[
            Entry(DATA, "short", f"{short} rows with fewer fields than the header filled up with NULL", None, short)
            for _ in range(short > 0)
        ],
        *_rows_entries("space", "outer spaces removed", [*texts, *timestamps], counts, "padded_rows"),
        *_rows_entries("special", "special characters removed", plain, counts, "special_rows"),
        *_rows_entries("placement", "misplaced characters removed", placed, counts, "special_rows"),
        *[
            Entry(DATA, "placement", f"column {name!r}: placement rule unused, it holds dates", name)
            for name in overruled
        ],
        *_rows_entries("missing", "empty values set to NULL", [*texts, *dates, *timestamps], counts,
                       "empty_rows"),
        *_rows_entries("date", "dates made ISO", dates, counts, "filled_rows", always=True),
        *_rows_entries("unparsed", "values that are no date set to NULL", dates, counts,
                       "unparsed_rows"),
        *_rows_entries("timestamp", f"timestamps {moved}", timestamps, counts, "filled_rows",
                       always=True),
        *_rows_entries("timestamp", f"timestamps {moved}", iso_timestamps, counts, moving),
        *_rows_entries("timestamp", f"timestamps {moved}", plan.of_kind(planning.TYPED_TIMESTAMP),
                       counts, "non_null", always=True),
        *_rows_entries("unparsed", "values that are no timestamp set to NULL", timestamps, counts,
                       "unparsed_rows"),
        *_rows_entries("integer", "text made integer", plan.of_kind(planning.INTEGER), counts,
                       "filled_rows"),
        *_rows_entries("float", "text made float", plan.of_kind(planning.FLOAT), counts,
                       "filled_rows"),
        *_key_entries(plan, counts),
    ]


def curate(
    df: DataFrame,
    config: CurationConfig | None = None,
    output_folder: str | None = None,
    log_folder: str | None = None,
    source: str = "table",
    output_format: str = "parquet",
    storage: Mapping[str, str] | None = None,
    malformed: str | None = None,
) -> CurationResult:
    """Curate a table. The number of jobs does not depend on its number of columns.

    The curated table is written once, and the result is what was written; the rows that are
    left are observed by the tasks that write them. Without an output folder it is written below the
    folder that the cluster names in spark.checkpoint.dir. ``source`` gives the written files their
    name. ``output_format`` is parquet, csv (a file for each task), or csv file (a single one).
    ``storage`` holds file-system settings for what is written and read back. ``malformed`` names
    the CSV reader's column for rows that have not as many fields as the header; those with more are
    kept apart.
    """
    if output_format not in ("parquet", "csv", "csv file"):
        raise ValueError(f"output_format {output_format!r} is neither parquet, csv nor csv file")
    spark = df.sparkSession
    now = datetime.now()
    learned = learn(df, config, malformed)
    plan, counts = learned.plan, learned.counts
    rows, apart = df, None
    if malformed is not None:
        rows = df.where(~kept_apart(malformed)).drop(malformed)
        line = column(malformed).getField("line").alias(malformed)
        apart = df.where(kept_apart(malformed)).withColumn(malformed, line)
    cleaned = planning.apply(rows, plan)
    by = keys.dedup_keys(cleaned.columns, plan.primary_key, plan.composite_keys)
    # Counted where rows are written, as a task that is run again before that would count twice.
    left = Observation()
    curated = keys.deduplicate(cleaned, by, plan.order_by).observe(left, F.count(F.lit(1)).alias("rows"))
    path = written = None
    if output_folder is None:
        path, output_format = scratch_folder(spark, "curated"), "parquet"
    else:
        path = written = writers.output_path(readers.spark_uri(output_folder), source, now)
    back = spark.read.schema(curated.schema).options(**(storage or {}))
    overwrite = log_folder is not None
    if output_format == "parquet":
        writers.write_parquet(curated, path, overwrite, storage)
        result = back.parquet(path)
    elif output_format == "csv":
        writers.write_csv(curated, path, overwrite=overwrite, settings=storage)
        result = back.option("header", True).csv(path)
    else:
        path = written = written + ".csv"
        writers.write_csv_file(curated, path, overwrite, storage)
        result = back.option("header", True).csv(path)
    # The composite key and the rows kept apart are counted beside the columns.
    before = max(row["rows"] for name, row in counts.items() if name not in (COMPOSITE, MALFORMED, SHORT))
    removed = before - left.get["rows"]
    if apart is not None and counts[MALFORMED]["non_null"]:
        aside = path.removesuffix(".csv") + "_malformed"
        writers.write_parquet(apart, aside, overwrite, storage)
        apart = spark.read.schema(apart.schema).options(**(storage or {})).parquet(aside)
    elif apart is not None:
        apart = spark.createDataFrame([], apart.schema)

    entries = [
        *_header_entries(learned.headers, learned.dropped),
        *_data_entries(plan, learned.config, counts),
        Entry(DATA, "duplicates", f"{removed} duplicates removed", ", ".join(by), removed),
    ]
    audit = audit_table(spark, entries, now)
    logged = None
    if log_folder is not None:
        logged = writers.log_path(readers.spark_uri(log_folder), source, now)
        writers.write_csv(audit, logged, single_file=True, settings=storage)
    return CurationResult(result, audit, plan, written, logged, apart)


def curate_data(
    path: str,
    logging_path: str | None = None,
    output_file_path: str | None = None,
    primary_key: str | None = None,
    composite_keys: Sequence[str] | None = None,
    valid_across_allcol: Iterable[str] | None = None,
    valid_spl_chars: Mapping[str, Sequence[int | str]] | None = None,
    inputtz: str | None = None,
    outputtz: str | None = None,
    aws_s3: Mapping[str, str] | None = None,
    azure_blob: Mapping[str, str] | None = None,
    spark: SparkSession | None = None,
    output_format: str = "parquet",
) -> CurationResult:
    """Curate the headered CSV at ``path``, a file or a folder of files that each have a header. Rows
    with more fields than their header are kept apart. The storage keys serve the outputs, too."""
    spark = spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    config = CurationConfig.of(
        primary_key, composite_keys, valid_across_allcol, valid_spl_chars, inputtz, outputtz
    )
    df = readers.read_csv(spark, path, aws_s3, azure_blob, readers.MALFORMED)
    # Without a header there is no such column. A file without rows shows at once, before any pass over the data.
    malformed = readers.MALFORMED if df.columns else None
    if df.columns and not header_rules.all_missing(df.columns[:-1]) and df.isEmpty():
        raise ValueError("the file holds column names but no rows")
    storage = readers.storage_settings(aws_s3, azure_blob)
    return curate(df, config, output_file_path, logging_path, path, output_format, storage, malformed)
