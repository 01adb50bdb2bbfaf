"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive words: some positions are hashed together, the others are ignored, so a
substituted word spoils only the seeds that look at it. Seeds of all benchmark items meet the seeds of all documents
in a join on the hash. Each hit names a document, an item and the shift between their words; along that shift the
words are compared one by one, and the overlap counts where some stretch of `stretch` words (the whole item where it
is shorter) agrees in at least `identity` of its words.

With the given stretch and identity the masks lose nothing: wherever the unequal words of a stretch fall, one of them
looks at equal words only, for 3 unequal words of 15, for 2 of 10 to 14, and for 1 of 5 to 9, whose masks are shorter.
For another stretch or identity the masks have to be chosen anew.

Words are stretches without space or the characters 9 to 13, in lower case. Items of fewer than 5 words have one seed, of
all their words, as the identity allows no unequal word there. Items of fewer than `fewest` words are left out; who
removes documents may not want those that hold a common word. Null and empty texts have no words. Rows with the same id and text count once. Null ids are kept as ids of their own.

Everything is a DataFrame operation. The benchmark's seeds are counted and broadcast in blocks of at most
`block_seeds`, so a larger benchmark takes more passes over the documents and not more memory.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rinse.llm.components import may_be_among
from rinse.llm.shared import written

#: Which of 8 consecutive words a seed looks at, for items of at least LONG words.
MASKS = ("111011", "11001011", "10100111")
LONG = 10
#: The same for items of SHORT to LONG - 1 words.
SHORT_MASKS = ("1111", "11101", "11011", "10111")
SHORT = 5


def word_hashes(text: Column) -> Column:
    """A hash of each word, in order; null where there is none."""
    inner = F.btrim(F.lower(text), F.lit(" \t\n\x0b\f\r"))
    words = F.split(inner, r"[\x20\x09-\x0D]+")
    return F.when(inner != "", F.transform(words, lambda w: F.xxhash64(w)))


def _seed(words: Column, at: Column, mask: str, number: int) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k, c in enumerate(mask) if c == "1"], F.lit(number))


def _seeds(rows: DataFrame, masks: list[str]) -> DataFrame:
    """A row for each word and mask, with `at` (the word's place) and `seed`; 0 where the mask does not fit."""
    count = len(masks)
    places = F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") * count - 1))
    every = rows.withColumn("_i", F.explode(places))
    at = F.expr(f"int(_i div {count})")
    seed = F.lit(0).cast("bigint")
    for number, mask in enumerate(masks):
        fits = (F.pmod(F.col("_i"), F.lit(count)) == number) & (at + len(mask) <= F.size("words"))
        seed = F.when(fits, _seed(F.col("words"), at, mask, number)).otherwise(seed)
    mask = F.pmod(F.col("_i"), F.lit(count))
    return every.withColumns({"at": at, "seed": seed, "mask": mask}).drop("_i")


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    masks: tuple[str, ...] = MASKS,
    short_masks: tuple[str, ...] = SHORT_MASKS,
    fewest: int = 1,
    stretch: int = 15,
    identity: float = 0.8,
    block_seeds: int = 500_000,
) -> DataFrame:
    """One row for each document (doc_id, text) and item (item_id, text) that overlap.

    doc_id, text_hash, item_id, start_word (where the item's first word falls in the document, for the shift that
    agrees best), agree (words that agree in its best stretch), stretch (words of a stretch).
    """
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("words")).where(F.size("words") >= fewest)
    items = written(items.distinct(), "benchmark-words")
    # The masks of the lengths below LONG that occur: short_masks together, and whole-item masks below SHORT.
    lengths = sorted(r.n for r in items.select(F.size("words").alias("n")).where(F.col("n") < LONG).distinct().collect())
    every_mask, owners = list(masks), [(LONG, None, 0, len(masks))]
    if any(n >= SHORT for n in lengths):
        owners.append((SHORT, LONG, len(every_mask), len(every_mask) + len(short_masks)))
        every_mask += short_masks
    for n in lengths:
        if n < SHORT:
            owners.append((n, n + 1, len(every_mask), len(every_mask) + 1))
            every_mask.append("1" * n)
    seeds = _seeds(items, every_mask).where("seed != 0").withColumnsRenamed({"words": "item_words", "at": "item_at"})
    own = F.lit(False)
    for least, below, first, end in owners:
        fits = (F.size("item_words") >= least) & (F.col("mask") >= first) & (F.col("mask") < end)
        own = own | (fits if below is None else fits & (F.size("item_words") < below))
    seeds = written(seeds.where(own).drop("mask"), "benchmark-seeds")
    blocks = -(-seeds.count() // block_seeds)
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), word_hashes(F.col("text")).alias("words"))
    windows = _seeds(texts, every_mask)
    shift = F.col("at") - F.col("item_at")
    front = F.greatest(-shift, F.lit(0))
    back = F.least(F.size("item_words"), F.size("words") - shift)
    hits = [
        windows.join(F.broadcast(seeds.where(F.pmod(F.col("seed"), F.lit(blocks)) == b) if blocks > 1 else seeds), "seed").select(
            "doc_id",
            "text_hash",
            "item_id",
            shift.alias("start_word"),
            F.slice("item_words", front + 1, back - front).alias("of_item"),
            F.slice("words", front + shift + 1, back - front).alias("of_doc"),
            F.least(F.lit(stretch), F.size("item_words")).alias("stretch"),
        )
        for b in range(max(1, blocks))
    ]
    # Written, as the comparison below would otherwise move into the join and be made before the hashes are compared.
    hits = written(reduce(DataFrame.unionByName, hits).distinct(), "seed-hits")
    agrees = F.zip_with("of_item", "of_doc", lambda a, b: a == b)
    starts = F.sequence(F.lit(1), F.size("of_item") - F.col("stretch") + 1)
    best = F.array_max(F.transform(starts, lambda t: F.size(F.filter(F.slice(agrees, t, F.col("stretch")), lambda x: x))))
    # Where both ends are cut off, less than a stretch may be left.
    agree = F.when(F.size("of_item") >= F.col("stretch"), best).otherwise(0)
    verified = hits.withColumn("agree", agree).where(F.col("agree") >= F.ceil(F.col("stretch") * F.lit(identity)))
    ranked = F.max(F.struct("agree", (-F.col("start_word")).alias("early"), "stretch")).alias("best")
    found = verified.groupBy("doc_id", "text_hash", "item_id").agg(ranked)
    return found.select(
        "doc_id",
        "text_hash",
        "item_id",
        (-F.col("best.early")).alias("start_word"),
        F.col("best.agree").alias("agree"),
        F.col("best.stretch").alias("stretch"),
    )


def without_overlaps(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents that overlap with no item, with all their columns. Only those that may overlap are shuffled."""
    found = overlaps(docs.select("doc_id", "text"), benchmark, **settings).select("doc_id", "text_hash").distinct()
    found = written(found, "overlapping")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumns({"own": F.col("row.doc_id"), "own_text": F.xxhash64("row.text")})
    rows = may_be_among(rows, F.struct("own", "own_text"), found, F.struct("doc_id", "text_hash"), "asked")
    same = F.col("own").eqNullSafe(F.col("doc_id")) & (F.col("own_text") == F.col("text_hash"))
    kept = rows.where("asked").join(found, same, "left_anti")
    return rows.where("not asked").select("row").unionByName(kept.select("row")).select("row.*")
