"""N-gram Jaccard self-join by chosen paths.

Texts are sets of hashed word n-grams. Equal texts are one set with a number of copies. Each set is represented by
`coordinates` min-hashes, of which two sets share each with the probability of their Jaccard similarity. In every run
the sets are split recursively: a node of the recursion samples two coordinates by its path, and a set goes to one
child for each, named by the token it has there. Children of at most `bucket` sets are compared by brute force. Of a
larger one, a few leaders are compared with all its sets on the first level. Sets that are alike to leaders which such sets join are in one
group whatever else they have in common, so a bucket with no other set is finished, and one with at most `signature_tile` others
compares just these with all. What is left is split again, down to `depth`, and what is large even then is compared by
brute force in tiles. So a large group of near copies is not carried through the levels, where its rows would nearly
double each time, also if a passage or a few hundred other sets stand in its buckets. A pair of similarity s survives a level with probability 1 - (1 - s(1 - q))**2, where q is its loss below, and
runs are repeated until a pair at the threshold is lost less often than `1 - recall`.

Comparison in buckets uses the min-hashes with a margin of six standard deviations, which loses another 3e-8 of the pairs
at the threshold, in all runs alike. What passes connects sets to
groups, and inside each group, whole or in tiles, every pair is compared exactly once by its n-grams, so similarities
and numbers of links are exact and no pair leaves a task. Components of the exact links are the classes.

Words are stretches without space or the characters 9 to 13, with A-Z as a-z; a text of fewer words than `n` is one
n-gram. Null texts are linked to nothing. Texts without words are linked to copies of the same text alone. Null ids
are kept; a class is called by its least id. Repeated rows are copies, each with a result row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rinse.llm.bytewords import mix, span_hashes, spans, text_slices
from rinse.llm.components import components, join_hot, may_be_among
from rinse.llm.shared import smaller_batches, tasks, written

_CHILDREN = 2
_DEVIATIONS = 6
_LEADERS = 8


def runs_for(recall: float, threshold: float, depth: int) -> int:
    """How many runs lose a pair at the threshold less often than 1 - recall."""
    lost = 0.0
    for _ in range(depth):
        lost = (1 - threshold * (1 - lost)) ** _CHILDREN
    return max(1, math.ceil(math.log(1 - recall) / math.log(lost)))


def ngram_hashes(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's n-grams, with repeats, and how many each row has."""
    starts, ends, first = spans(data, offsets)
    words = span_hashes(data, starts, ends)
    count = np.diff(first)
    grams = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    row = np.repeat(np.arange(len(count)), grams)
    at = np.arange(len(row)) - np.repeat(np.cumsum(grams) - grams, grams) + first[:-1][row]
    out = np.full(len(row), np.uint64(0x2545F4914F6CDD1D))
    for k in range(n):
        inside = k < count[row]  # a row of fewer words is one n-gram
        word = words[np.where(inside, at + k, 0)] if len(words) else out
        out = np.where(inside, mix(out * np.uint64(0x9E3779B97F4A7C15) + word), out)
    return out, grams


def signatures(grams: np.ndarray, counts: np.ndarray, coordinates: int) -> np.ndarray:
    """Rows x coordinates; rows without n-grams are left at 0."""
    out = np.zeros((len(counts), coordinates), dtype="<u4")
    there = counts > 0
    if len(grams):
        starts = (np.cumsum(counts) - counts)[there]
        seeds = mix(np.arange(1, coordinates + 1, dtype=np.uint64))
        for k in range(coordinates):
            x = (grams ^ seeds[k]) * np.uint64(0xD6E8FEB86659FD93)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            out[there, k] = np.minimum.reduceat((x >> np.uint64(32)).astype(np.uint32), starts)
    return out


def _matrix(column: pa.Array, coordinates: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4").reshape(-1, coordinates)


def _sampled(paths: np.ndarray, coordinates: int) -> list[np.ndarray]:
    """Two different coordinates for each path."""
    one = mix(paths ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(coordinates)
    two = (one + np.uint64(1) + mix(paths ^ np.uint64(0xE7037ED1A0B428DB)) % np.uint64(coordinates - 1)) % np.uint64(coordinates)
    return [one.astype(np.int64), two.astype(np.int64)]


def _children(rows: DataFrame, coordinates: int) -> DataFrame:
    """(node, path, signature) to (node, path) of its children."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = _matrix(batch.column("signature"), coordinates)
            paths = batch.column("path").to_numpy().astype(np.uint64)
            for at in _sampled(paths, coordinates):
                token = matrix[np.arange(len(matrix)), at].astype(np.uint64)
                child = mix(mix(paths + np.uint64(0x8EBC6AF09C88C6E3)) ^ mix((at.astype(np.uint64) << np.uint64(32)) | token))
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(child.astype(np.int64))], names=["node", "path"])

    return rows.select("node", "path", "signature").mapInArrow(split, "node binary, path bigint")


def _roots(links: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links, the least row of its component."""
    root = np.arange(len(links))
    while True:
        near = np.where(links, root[None, :], len(root)).min(axis=1, initial=len(root))
        new = np.minimum(root, near)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _alike(a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
    """Which rows of a and b share at least so many coordinates."""
    if len(a) * len(b) <= 1024:
        return (a[:, None, :] == b[None, :, :]).sum(axis=2) >= least
    same = np.zeros((len(a), len(b)), dtype=np.int16)
    for k in range(a.shape[1]):
        same += a[:, k, None] == b[None, :, k]
    return same >= least


def _compared(groups: DataFrame, coordinates: int, least: int) -> DataFrame:
    """Edges that span what is alike in each row's list of members (side, node, signature).

    Members of different sides meet, or all where there is one side. A task leaves out edges that join nothing new to
    what it has joined before, as the same sets meet in many buckets.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[bytes, bytes] = {}

        def top(x: bytes) -> bytes:
            while (up := above.get(x, x)) != x:
                above[x] = above.get(up, up)
                x = up
            return x

        for batch in batches:
            us: list[bytes] = []
            vs: list[bytes] = []
            for members in batch.column("members"):
                side = np.array([x["side"].as_py() for x in members])
                nodes = [x["node"].as_py() for x in members]
                matrix = np.frombuffer(b"".join(x["signature"].as_py() for x in members), dtype="<u4").reshape(-1, coordinates)
                links = _alike(matrix, matrix, least)
                if side.any():
                    links &= side[:, None] != side[None, :]
                root = _roots(links)
                for k in np.flatnonzero(root != np.arange(len(root))).tolist():
                    one, two = top(nodes[k]), top(nodes[root[k]])
                    if one != two:
                        above[one] = two
                        us.append(nodes[k])
                        vs.append(nodes[root[k]])
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], names=["u", "v"])

    return groups.select("members").mapInArrow(compare, "u binary, v binary")


def _joined_leaders(masks: list[int]) -> int:
    """The leaders that sets with these masks (which leaders a set is alike to) join with the first leader."""
    main, last = 1, 0
    while main != last:
        last = main
        for mask in masks:
            if mask & main:
                main |= mask
    return main


def _led(large: DataFrame, total: int, coordinates: int, least: int, tile: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(edges, groups to be compared with members as in _compared, rows of buckets that remain) of large buckets.

    `large` has path, node, signature and size.
    """
    chosen = [F.min(F.struct(F.xxhash64("node", F.lit(i)).alias("h"), "node", "signature")).alias(f"l{i}") for i in range(_LEADERS)]
    heads = large.groupBy("path").agg(F.count("*").alias("size"), *chosen)
    fields = {"heads": "node", "signatures": "signature"}
    heads = heads.select("path", "size", *[F.array(*[F.col(f"l{i}")[of] for i in range(_LEADERS)]).alias(to) for to, of in fields.items()])
    joined = join_hot(large.select("path", "node", "signature"), written(heads, "path-heads", total), "path", "size", total)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = _matrix(batch.column("signature"), coordinates)
            of_heads = _matrix(batch.column("signatures").flatten(), coordinates).reshape(len(own), _LEADERS, coordinates)
            mask = np.zeros(len(own), dtype=np.int32)
            for i in range(_LEADERS):
                mask |= ((own == of_heads[:, i]).sum(axis=1) >= least).astype(np.int32) << i
            names = ["path", "node", "signature", "size", "heads"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(mask)], names=[*names, "mask"])

    marked = joined.mapInArrow(mark, "path bigint, node binary, signature binary, size bigint, heads array<binary>, mask int")
    marked = written(marked, "path-marked", total)
    # At most 2**_LEADERS masks for a path.
    masks = marked.groupBy("path", "mask").agg(F.count("*").alias("n"), F.first("heads").alias("heads"))
    seen = masks.groupBy("path").agg(
        F.collect_list("mask").alias("masks"), F.collect_list("n").alias("counts"), F.first("heads").alias("heads"), F.sum("n").alias("size")
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mains, rests, us, vs = [], [], [], []
            rows = zip(*[batch.column(n).to_pylist() for n in ("masks", "counts", "heads")])
            for masks, counts, heads in rows:
                main = _joined_leaders(masks)
                mains.append(main)
                rests.append(sum(n for mask, n in zip(masks, counts) if not mask & main))
                # Leaders that one set is alike to are joined by it.
                pairs = {(heads[i], heads[j]) for mask in masks for i in range(_LEADERS) for j in range(i) if mask >> i & mask >> j & 1}
                us.append([u for u, _ in pairs])
                vs.append([v for _, v in pairs])
            arrays = [batch.column("path"), batch.column("size"), pa.array(mains, pa.int32()), pa.array(rests, pa.int64())]
            lists = [pa.array(x, pa.list_(pa.binary())) for x in (us, vs)]
            yield pa.RecordBatch.from_arrays([*arrays, *lists], names=["path", "size", "main", "rest", "us", "vs"])

    kinds = "path bigint, size bigint, main int, rest bigint, us array<binary>, vs array<binary>"
    seen = written(seen.mapInArrow(judge, kinds), "path-seen", total)
    lowest = F.expr(" ".join(["case", *[f"when mask & {1 << i} != 0 then heads[{i}]" for i in range(_LEADERS)], "end"]))
    edges = marked.where("mask != 0").select(F.col("node").alias("u"), lowest.alias("v")).unionByName(
        seen.select(F.explode(F.arrays_zip("us", "vs")).alias("e")).select(F.col("e.us").alias("u"), F.col("e.vs").alias("v"))
    )
    open_paths = seen.where("rest > 0").select("path", "size", "main", "rest")
    rows = join_hot(marked.select("path", "node", "signature", "mask"), open_paths, "path", "size", total)
    few = rows.where(F.col("rest") <= tile).withColumn("other", F.expr("mask & main = 0"))
    parts = F.ceil(F.col("size") / tile)
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))
    member = F.struct(F.col("other").cast("int").alias("side"), "node", "signature")
    # The others go to each part of the rest, and meet among themselves in a group of their own.
    spread = few.where("not other").withColumn("part", F.pmod(F.xxhash64("node"), parts)).unionByName(few.where("other").withColumn("part", every))
    spread = spread.unionByName(few.where("other").withColumn("part", F.lit(-1).cast("bigint")).withColumn("other", F.lit(False)))
    groups = spread.groupBy("path", "part").agg(F.collect_list(member).alias("members"))
    return edges.where("u != v"), groups, rows.where(F.col("rest") > tile).select("path", "node", "signature", "size")


def _tiled(rows: DataFrame, parts: Column) -> DataFrame:
    """Deals the rows of a group to `parts` parts and repeats them for each pair of parts: columns a, b and side.

    Rows of one part meet in tile (a, a), those of two parts in (a, b), where side tells the part.
    """
    dealt = rows.withColumn("_parts", parts).withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_parts")))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts").cast("bigint") - 1)))
    return dealt.withColumns(
        {
            "a": F.least("_own", "_other"),
            "b": F.greatest("_own", "_other"),
            "side": (F.col("_own") > F.col("_other")).cast("int"),
        }
    ).drop("_parts", "_own", "_other")


@dataclass(frozen=True)
class JaccardClasses:
    #: node (of each different text), doc_id, copies; signature
    texts: DataFrame
    #: node, class_node, class_id, copies, n_links: of texts that have copies or links
    linked: DataFrame


def text_node(text: str = "text") -> Column:
    """Names a text by its checksum; null for null."""
    return F.unhex(F.md5(F.col(text).cast("binary")))


def jaccard_classes(
    docs: DataFrame,
    *,
    n: int = 5,
    threshold: float = 0.8,
    recall: float = 0.99999,
    coordinates: int = 128,
    bucket: int = 64,
    depth: int = 4,
    tile: int = 400,
    signature_tile: int = 1000,
) -> JaccardClasses:
    """Links all texts of `docs` (doc_id, text) with a Jaccard similarity of at least `threshold`."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text")):
                grams, counts = ngram_hashes(data, offsets, n)
                matrix = signatures(grams, counts, coordinates)
                signed = [matrix[k].tobytes() if counts[k] else None for k in range(end - first)]
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("node"), pa.array(signed, pa.binary())],
                    names=["doc_id", "node", "signature"],
                )

    with_node = docs.select("doc_id", "text", text_node().alias("node")).where("text is not null")
    signed = with_node.mapInArrow(sign, "doc_id bigint, node binary, signature binary")
    texts = signed.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("signature").alias("signature")
    )
    with smaller_batches(docs.sparkSession):
        texts = written(texts, "path-texts")
    sets = texts.where("signature is not null").select("node", "signature")

    runs = runs_for(recall, threshold, depth)
    least = math.ceil(coordinates * (threshold - _DEVIATIONS * math.sqrt(threshold * (1 - threshold) / coordinates)))
    roots = mix(np.arange(1, runs + 1, dtype=np.uint64)).astype(np.int64).tolist()
    paths = sets.withColumn("path", F.explode(F.array(*[F.lit(r) for r in roots])))
    edges = None
    for level in range(1, depth + 1):
        rows = written(_children(paths, coordinates), "path-rows")
        total = rows.count()
        # No path is null; as the filter is said here, joins have none of their own to add, and share one shuffle.
        sizes = rows.where("path is not null").groupBy("path").agg(F.count("*").alias("size")).where("size > 1")
        sized = written(join_hot(rows, sizes, "path", "size", total).join(sets, "node"), "path-sized", total)
        small = sized.where(F.col("size") <= bucket).withColumn("side", F.lit(0)).groupBy("path")
        found = _compared(small.agg(F.collect_list(F.struct("side", "node", "signature")).alias("members")), coordinates, least)
        paths = sized.where(F.col("size") > bucket)
        if level == 1:
            led, groups, paths = _led(paths, paths.count(), coordinates, least, signature_tile)
            found = found.unionByName(_compared(groups, coordinates, least)).unionByName(led)
        if level < depth:
            paths = written(paths, "path-open")
            # Later levels have a few of the sets; the signatures of others are not shuffled again.
            sets = paths.groupBy("node").agg(F.first("signature").alias("signature"))
        else:
            tiles = _tiled(paths, F.ceil(F.col("size") / signature_tile)).groupBy("path", "a", "b")
            tiles = tiles.agg(F.collect_list(F.struct("side", "node", "signature")).alias("members"))
            found = found.unionByName(_compared(tiles, coordinates, least))
        found = written(found.distinct(), "path-edges", total)
        edges = found if edges is None else edges.unionByName(found)
        if level < depth and paths.isEmpty():
            break

    groups = written(components(edges, "path-groups"), "path-groups")
    group_sizes = groups.groupBy("component").agg(F.count("*").alias("members"))
    in_groups = groups.count()
    grouped = join_hot(groups, group_sizes, "component", "members", in_groups)
    grouped = grouped.join(texts.select("node", F.col("doc_id").alias("_id"), "copies"), "node")
    # Most texts are in no group, and are not shuffled.
    asked = may_be_among(with_node, F.col("node"), groups, F.col("node"), "asked").where("asked").drop("asked")
    whole = asked.join(
        grouped.withColumnRenamed("node", "_node"), (F.col("node") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    ).dropDuplicates(["node"])
    tiles = _tiled(whole, F.ceil(F.col("members") / tile))
    # Many small groups share a task's group; a tile of a large one has its own.
    shelves = max(tasks(docs.sparkSession), in_groups // tile)
    shelf = F.when(F.col("members") <= tile, F.pmod(F.xxhash64("component"), F.lit(shelves))).otherwise(
        F.xxhash64("component", "a", "b")
    )
    compared = tiles.withColumn("shelf", shelf).select("shelf", "component", "a", "b", "side", "node", "copies", "text")

    def exact(group: pa.Table) -> pa.Table:
        return _exact_links(group, n, threshold)

    links = compared.groupBy("shelf").applyInArrow(exact, "node binary, root binary, links bigint")
    links = written(links, "path-links")
    classes = components(links.select(F.col("node").alias("u"), F.col("root").alias("v")), "path-classes")
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    ids = texts.select("node", "doc_id", "copies")
    members = ids.join(classes, "node", "left").join(counted, "node", "left").where("copies > 1 or component is not null")
    members = members.withColumn("class_node", F.coalesce("component", "node"))
    members = written(members, "path-members")
    named = members.groupBy("class_node").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n"))
    linked = join_hot(members, named, "class_node", "n", members.count()).select(
        "node",
        "class_node",
        "class_id",
        "copies",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    return JaccardClasses(texts, written(linked, "path-linked"))


def _exact_links(group: pa.Table, n: int, threshold: float) -> pa.Table:
    """For each text with links in this group of texts: the least text of its component here, and its links.

    A link to a text counts for all its copies. Links inside a part count in tile (a, a) alone.
    """
    sets: list[np.ndarray] = []
    text = group.column("text").combine_chunks()
    for _, _, data, offsets in text_slices(text):
        grams, counts = ngram_hashes(data, offsets, n)
        sets += [np.unique(x) for x in np.split(grams, np.cumsum(counts)[:-1])]
    nodes, copies = group.column("node").to_pylist(), group.column("copies").to_numpy()
    side = group.column("side").to_numpy()
    tile = list(zip(group.column("component").to_pylist(), group.column("a").to_pylist(), group.column("b").to_pylist()))
    members: dict[tuple, list[int]] = {}
    for k, name in enumerate(tile):
        members.setdefault(name, []).append(k)
    out: tuple[list, list, list] = ([], [], [])
    for own in members.values():
        own.sort(key=nodes.__getitem__)
        shared = _shared([sets[k] for k in own])
        sizes = np.array([len(sets[k]) for k in own])
        union = sizes[:, None] + sizes[None, :] - shared
        links = shared >= threshold * union - 1e-9
        if side[own].any():
            links &= side[own][:, None] != side[own][None, :]
        np.fill_diagonal(links, False)
        weight = links @ copies[own]
        root = _roots(links)
        for k in np.flatnonzero(links.any(axis=1)).tolist():
            out[0].append(nodes[own[k]])
            out[1].append(nodes[own[root[k]]])
            out[2].append(int(weight[k]))
    return pa.table([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.int64())], names=["node", "root", "links"])


def _shared(sets: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """How many elements each two sets share."""
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, which, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    often = times[which] > 1
    row, at = row[often], column[which[often]]
    total = int((times > 1).sum())
    shared = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    for low in range(0, total, width):
        here = slice(*np.searchsorted(at, [low, low + width]))
        block = np.zeros((len(sets), min(width, total - low)), dtype=np.float32)
        block[row[here], at[here] - low] = 1
        shared += block @ block.T
    sizes = [len(x) for x in sets]
    shared[np.arange(len(sets)), np.arange(len(sets))] = sizes
    return np.rint(shared).astype(np.int64)


def with_classes(docs: DataFrame, found: JaccardClasses) -> DataFrame:
    """One row per document (doc_id, text): doc_id, class_id, n_links."""
    linked = found.linked.select(F.col("node").alias("_node"), "class_id", "n_links")
    rows = docs.select("doc_id", text_node().alias("node")).join(linked, F.col("node") == F.col("_node"), "left")
    return rows.select(
        "doc_id",
        F.when(F.col("_node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
    )


def one_of_each(docs: DataFrame, found: JaccardClasses) -> DataFrame:
    """The documents without copies or links, and of each class the one with the least id; all columns stay.

    Rows are packed while names are given, so columns of any name are kept. Only documents that may have copies or links
    are shuffled.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("own", text_node("row.text"))
    linked = found.linked.select(F.col("node").alias("own"), "class_node", "class_id", "copies")
    rows = may_be_among(rows, F.col("own"), linked, F.col("own"), "asked")
    total = found.texts.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    joined = join_hot(rows.where("asked and own is not null").drop("asked"), linked, "own", "copies", total, "left")
    alone = joined.where("class_node is null").select("row")
    least = joined.where(F.col("class_node").isNotNull() & F.col("row.doc_id").eqNullSafe(F.col("class_id"))).dropDuplicates(["class_node"])
    return rows.where("not asked or own is null").select("row").unionByName(alone).unionByName(least.select("row")).select("row.*")
