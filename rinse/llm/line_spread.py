"""Removal of lines that are spread over many sites.

A line's spread is the number of distinct sites on which it stands. HyperLogLog sketches of the sites, one per line
hash, are built in the tasks and merged by aggregation. Where a sketch's estimate is surely over or under the
threshold, it decides; lines near the threshold get exact distinct counts of their sites. Lines on at least
`min_sites` sites are boilerplate and leave every document.

Lines are what stands between line feeds, without outer spaces, tabs and carriage returns; blank lines are never
boilerplate. A null site is a site of its own. Null texts have no lines and stay null. Repeated rows add nothing to a
spread. Lines are told apart by two 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rinse.llm.components import join_hot, may_be_among
from rinse.llm.shared import written

#: Relative standard error of a sketch with 2**k registers is about 1.04 / sqrt(2**k); four of them are the margin.
_REGISTERS = 11


def _trimmed(text: Column) -> Column:
    return F.transform(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(" \t\r")))


def line_spreads(docs: DataFrame, min_sites: int, site_column: str) -> DataFrame:
    """(line, check) of the boilerplate lines, with `sites`, exact where `exact` and else estimated."""
    site = F.coalesce(F.concat(F.lit("="), F.col(site_column).cast("string")), F.lit(""))
    lines = docs.select(site.alias("site"), F.explode(_trimmed(F.col("text"))).alias("text")).where("text != ''")
    lines = lines.select("site", F.xxhash64("text").alias("line"), F.xxhash64(F.lit(1), "text").alias("check"))
    # A line counts once for each site and task before it is sketched.
    sketched = lines.groupBy("line", "check").agg(F.count("*").alias("n"), F.hll_sketch_agg("site", F.lit(_REGISTERS)).alias("sketch"))
    spread = sketched.select("line", "check", "n", F.hll_sketch_estimate("sketch").alias("estimate"))
    margin = 4 * 1.04 / 2 ** (_REGISTERS / 2)
    low, high = min_sites * (1 - margin) - 1, min_sites * (1 + margin) + 1
    spread = written(spread.where((F.col("estimate") >= low) & (F.col("n") >= min_sites)), "line-spread")
    sure = spread.where(F.col("estimate") > high).select("line", "check", F.col("estimate").alias("sites"), F.lit(False).alias("exact"))
    near = spread.where(F.col("estimate") <= high).select("line", F.col("check").alias("_check"), "n")
    total = spread.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    pairs = join_hot(lines, near, "line", "n", total).where("check = _check").select("line", "check", "site").distinct()
    counted = pairs.groupBy("line", "check").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites)
    found = sure.unionByName(counted.withColumn("exact", F.lit(True)))
    return found.join(spread.select("line", "check", "n"), ["line", "check"])


def without_spread_lines(
    docs: DataFrame, *, min_sites: int = 5, site_column: str = "source", into: str = "line_spread"
) -> DataFrame:
    """The rows with a struct column `into`: n_lines, removed (numbers of the lines, from 0), kept (the rest of the text)."""
    rows = docs.drop(into) if into in docs.columns else docs
    bad = written(line_spreads(docs, min_sites, site_column), "line-boilerplate")
    bad = bad.select("line", F.col("check").alias("_check"), "n")
    total = bad.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # What leaves a text depends on the text alone, so copies of a text share their rows here.
    text_key = F.md5(F.col("text").cast("binary"))
    placed = docs.select(text_key.alias("key"), F.posexplode(_trimmed(F.col("text"))).alias("at", "text")).where("text != ''")
    placed = placed.select("key", "at", F.xxhash64("text").alias("line"), F.xxhash64(F.lit(1), "text").alias("check"))
    leaves = join_hot(placed, bad, "line", "n", total).where("check = _check").select("key", "at").distinct()
    leaves = leaves.groupBy("key").agg(F.array_sort(F.collect_list("at")).alias("_leaves"))
    # Rows are packed while names are given, so columns of any name are kept.
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")).withColumn("key", F.md5(F.col("row.text").cast("binary")))
    leaves = written(leaves, "line-leaves")
    packed = may_be_among(packed, F.col("key"), leaves, F.col("key"), "asked")
    untouched = packed.where("not asked or key is null").select("row", F.array().cast("array<int>").alias("leaves"))
    copies = docs.groupBy(text_key.alias("key")).agg(F.count("*").alias("n"))
    of_text = written(leaves.join(copies, "key"), "line-texts")
    touched = join_hot(packed.where("asked and key is not null"), of_text, "key", "n", docs.count(), "left")
    touched = touched.select("row", F.coalesce("_leaves", F.array().cast("array<int>")).alias("leaves"))
    leaves, text = F.col("leaves"), F.col("row.text")
    lines = F.split(text, "\n", -1)
    kept = F.array_join(F.filter(lines, lambda x, at: ~F.array_contains(leaves, at)), "\n")
    result = F.struct(
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        leaves.alias("removed"),
        F.when(F.size(leaves) == 0, text).otherwise(kept).alias("kept"),
    )
    return untouched.unionByName(touched).select("row.*", result.alias(into))
