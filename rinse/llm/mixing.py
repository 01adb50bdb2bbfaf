"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled by a checksum of their ids and laid end to end; the line of words is cut into
blocks of equally many words. Slot i of the schedule takes the fractional part of i times the golden ratio, and the
cumulative target shares map that point to a source, so every stretch of the schedule holds the sources in nearly
their shares. The r-th slot of a source reads its r-th block, and starts again from the first after the last. A
source's reading ends at its target: the last slot may read the front of its block alone, and sources of which the
points gave too few slots get the missing ones at the end.

Everything is a DataFrame operation. Hot sources are dealt out by the first digits of the checksum, and slots by
stretches of the schedule, so that running sums and ranks need no source in one task.

Words are stretches without space or the characters 9 to 13. Null texts have no words. A null source is a source
of its own. Documents without words are never read. Documents with equal ids stand in the order of their sizes;
rows that are equal in both are interchangeable. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rinse.llm.shared import written

_UNIT = 1 << 31
_GOLDEN = 1327217885  # odd, next to 2**31 / 1.618...
_STRETCH = 1 << 14
_CELL = 1 << 19


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, *, share: float, most: float) -> DataFrame:
    """`sizes` (source, source_size, weight) with `target`: `share` of all sizes dealt by weight.

    No target exceeds `most` times its source's size; what is over goes to the others by weight, until none is above.
    """
    by_room = Window.orderBy("room", F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    most_words = F.col("source_size") * F.lit(float(most))
    room = sizes.withColumn("room", most_words / F.col("weight"))
    level = (F.col("budget") - F.coalesce(F.sum(most_words).over(before), F.lit(0.0))) / (
        F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levels = room.withColumns(
        {
            "budget": F.sum("source_size").over(everything) * F.lit(float(share)),
            "weights": F.sum("weight").over(everything),
        }
    ).withColumn("level", level)
    # Sources in ascending order of room are full until the first that has room for its share.
    final = F.min(F.when(F.col("room") >= F.col("level"), F.struct("room", "level"))).over(everything)["level"]
    target = F.least(most_words, F.coalesce(F.col("final") * F.col("weight"), most_words))
    return levels.withColumn("final", final).select("source", "source_size", "weight", target.alias("target"))


def cycled_weights(sources: DataFrame, cycle: tuple[float, ...]) -> DataFrame:
    """Adds `weight`: the cycle's values dealt to the sources by code point, null last."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    values = F.array(*[F.lit(float(x)) for x in cycle])
    return sources.withColumn("weight", F.element_at(values, (rank % len(cycle) + 1).cast("int")))


@dataclass(frozen=True)
class Mix:
    #: doc_id, source, size, source_size, target, taken, passes (how often any of its words are read)
    documents: DataFrame
    #: slot, source, pass, block, words: in this order the blocks are read
    schedule: DataFrame
    block_words: int


def mix_sources(
    docs: DataFrame,
    *,
    share: float = 1.5,
    most: float = 2.0,
    cycle: tuple[float, ...] = (3.0, 1.0, 2.0),
    weights: DataFrame | None = None,
    block_words: int = 4096,
    least_slots: int = 1 << 16,
) -> Mix:
    """Mixes all rows of `docs` (doc_id, source, text). `weights` (source, weight) replaces the cycle.

    Blocks hold `block_words` words, or fewer where there would be under `least_slots` slots.
    """
    spark = docs.sparkSession
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    lines = written(
        docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
        .withColumn("key", key)
        .withColumn("deal", F.substring("key", 1, 3)),
        "mix-sizes",
    )
    deals = lines.groupBy("source", "deal").agg(F.sum("size").alias("deal_size"))
    sizes = deals.groupBy("source").agg(F.sum("deal_size").alias("source_size"))
    if weights is None:
        sizes = cycled_weights(sizes, cycle)
    else:
        given = weights.select(F.col("source").alias("of"), F.col("weight").cast("double").alias("weight"))
        sizes = sizes.join(given, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    # One row per source from here on; whole words are read.
    targets = source_targets(sizes, share=share, most=most).withColumn("words", F.floor("target"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    targets = targets.withColumn("k", F.row_number().over(by_name))
    targets = written(targets, "mix-targets")
    total = targets.agg(F.sum("words")).first()[0] or 0
    block = max(1, min(block_words, -(-total // least_slots)))
    slots = -(-total // block)

    up_to = F.sum("words").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    point_of = lambda words: F.floor(words / F.lit(float(max(total, 1))) * F.lit(float(_UNIT))).cast("bigint")
    plan = (
        targets.withColumn("up_to", up_to)
        .where("words > 0")
        .select(
            "k",
            "source",
            "words",
            "source_size",
            F.ceil(F.col("source_size") / block).alias("blocks"),
            point_of(F.col("up_to") - F.col("words")).alias("low"),
            point_of(F.col("up_to")).alias("high"),
        )
    )
    rest = F.pmod(F.col("words"), F.col("source_size"))
    plan = plan.withColumn("quota", F.floor(F.col("words") / F.col("source_size")) * F.col("blocks") + F.ceil(rest / block))

    # Points to sources, through cells of the unit interval.
    cells = F.explode(F.sequence(F.floor(F.col("low") / _CELL), F.floor((F.col("high") - 1) / _CELL)))
    ranges = plan.where("high > low").select("k", "low", "high", cells.alias("cell"))
    points = spark.range(slots).select(F.col("id").alias("slot"), F.pmod(F.pmod(F.col("id"), F.lit(_UNIT)) * _GOLDEN, F.lit(_UNIT)).alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") / _CELL))
    dealt = points.join(ranges, "cell").where("point >= low and point < high").select("slot", "k")

    # The rank of a slot among those of its source: earlier stretches, then within the stretch.
    dealt = dealt.withColumn("stretch", F.floor(F.col("slot") / _STRETCH))
    counted = dealt.groupBy("k", "stretch").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("k").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1))
    counted_before = counted.select("k", "stretch", F.coalesce(earlier, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("k", "stretch").orderBy("slot")) - 1
    ranked = (
        dealt.withColumn("within", within)
        .join(counted_before, ["k", "stretch"])
        .select("slot", "k", (F.col("within") + F.col("before")).alias("rank"))
    )
    got = counted.groupBy("k").agg(F.sum("n").alias("got"))
    late = plan.join(got, "k", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < quota")
    late = late.select("k", F.explode(F.sequence(F.col("got"), F.col("quota") - 1)).alias("rank"))
    late = late.select((F.lit(slots) + F.col("rank") * F.lit(1 << 20) + F.col("k")).alias("slot"), "k", "rank")

    here = F.col("block") * block
    schedule = (
        ranked.unionByName(late)
        .join(plan, "k")
        .where("rank < quota")
        .withColumn("pass", F.floor(F.col("rank") / F.col("blocks")))
        .withColumn("block", F.pmod(F.col("rank"), F.col("blocks")))
        .select(
            "slot",
            "k",
            "source",
            "pass",
            "block",
            F.least(
                F.lit(block).cast("bigint"),
                F.col("source_size") - here,
                F.col("words") - F.col("pass") * F.col("source_size") - here,
            ).alias("words"),
        )
    )

    # Where each document stands in its source's line.
    ahead = F.sum("deal_size").over(Window.partitionBy("source").orderBy("deal").rowsBetween(Window.unboundedPreceding, -1))
    places = deals.withColumn("ahead", F.coalesce(ahead, F.lit(0)))
    info = targets.select(F.col("source").alias("of"), "k", "source_size", "target")
    places = places.join(info, F.col("source").eqNullSafe(F.col("of")))
    places = places.select(F.col("source").alias("of"), F.col("deal").alias("in_deal"), "ahead", "k", "source_size", "target")
    own = F.sum("size").over(
        Window.partitionBy("source", "deal").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = lines.withColumn("own", own).join(
        places, F.col("source").eqNullSafe(F.col("of")) & (F.col("deal") == F.col("in_deal"))
    )
    placed = placed.select(
        "doc_id", "source", "size", "source_size", "target", "k", (F.col("ahead") + F.col("own") - F.col("size")).alias("start")
    )
    names = ["doc_id", "source", "size", "source_size", "target", "k", "start"]
    end = F.col("start") + F.col("size")
    pieces = placed.where("size > 0").select(
        *names, F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))).alias("block")
    )
    front = F.greatest(F.col("start"), here)
    back = F.least(end, here + F.col("words"))
    read = pieces.join(schedule.select("k", "block", "words", "pass"), ["k", "block"], "left")
    taken = F.when(F.col("words").isNull(), 0).otherwise(F.greatest(back - front, F.lit(0)))
    read = read.withColumn("taken", taken).groupBy(*names).agg(
        F.sum("taken").alias("taken"), (F.coalesce(F.max(F.when(F.col("taken") > 0, F.col("pass"))), F.lit(-1)) + 1).alias("passes")
    )
    without = placed.where("size = 0").select(*names, F.lit(0).cast("bigint").alias("taken"), F.lit(0).cast("bigint").alias("passes"))
    documents = read.unionByName(without).drop("k", "start")
    return Mix(documents, schedule.drop("k"), block)


def mixed_rows(docs: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` of which the mix reads words, repeated for each pass that does; all columns stay.

    Rows with the same id, source and number of words share what the mix gave them, the most passes in the order of
    their texts. Rows are packed while names are given, so columns of any name are kept, and are shuffled once.
    """
    mixed = mix_sources(docs.select("doc_id", "source", "text"), **settings).documents
    # Null ids and sources are keys like others.
    key = lambda doc, source, size: F.to_json(F.struct(doc.alias("d"), source.cast("string").alias("s"), size.alias("n")))
    given = mixed.select(key(F.col("doc_id"), F.col("source"), F.col("size")).alias("key"), "passes")
    # How many rows of a key are read how often; there are no more numbers of passes than a source may be read.
    counts = given.groupBy("key", "passes").agg(F.count("*").alias("n"))
    by_key = counts.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("passes", "n")), False).alias("shares"), F.max("passes").alias("most"))
    by_key = written(by_key.where("most > 0"), "mix-passes")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, key(F.col("doc_id"), F.col("source"), word_count(F.col("text"))).alias("key"))
    joined = rows.join(by_key, "key")
    same = joined.where(F.size("shares") == 1).select("row", F.col("most").alias("passes"))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("row.text")))
    mixed_keys = joined.where(F.size("shares") > 1).withColumn("place", place)
    up_to = lambda k: F.aggregate(F.slice("shares", 1, k), F.lit(0).cast("bigint"), lambda total, x: total + x["n"])
    own = F.filter("shares", lambda x, k: F.col("place") <= up_to(k + 1))[0]["passes"]
    repeated = same.unionByName(mixed_keys.select("row", own.alias("passes"))).where("passes > 0")
    return repeated.withColumn("pass", F.explode(F.sequence(F.lit(1).cast("bigint"), "passes"))).select("row.*")
