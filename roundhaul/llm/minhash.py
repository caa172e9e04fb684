"""MinHash near-duplicates with tensored banding, verified on full shingle sets.

Two small collections of half keys, each made of a few minhashes, are computed for a set; every
pair of half keys, one from either collection, is a key of one table. So `halves`^2 tables take
2 * `halves` half keys, a square root of the minhashes that independent tables would take.

Documents with equal sets are one class, hashed once. A half key that one class alone has can be in
no shared table key, so pairs are made of the others only; that drops nothing. In each bucket the
smallest class is a hub and every other one is compared with it alone. Once those links are joined
into components, the classes of buckets that still hold several components are compared with all
that share a half key of the first collection, which every pair of a bucket does: in blocks of
bounded size, inside tasks, without listing pairs. So no link between different texts that a bucket
shows is lost. A link counts only if the full sets confirm it.

Words are what stands between the six ASCII white-space characters, A-Z lower-cased. A text
with fewer words than a shingle has its whole sequence as its one shingle; NULL texts and those
without words have an empty set and link with nothing. Every row is linked by its own text, also
where rows share a doc_id; classes are told apart by their sets, not by ids. A row without a doc_id
links with nothing, has no component and is kept. Repeated rows stay; other columns are left out;
an empty table gives no rows. Shingles and words are known by 64-bit hashes (`hashing`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundhaul.llm.blocks import block_pairs, by_block, forest, groups
from roundhaul.llm.chunks import joined
from roundhaul.llm.common import Scratch, binary_array, list_array, mix64, reachable, text_blocks
from roundhaul.llm.components import components
from roundhaul.llm.hashing import range_hashes

WORDS = 5
PERCENT = 80
#: Half keys in each collection, and minhashes in each half key: a pair at 80 % shares a table key with 99.996 %.
HALVES, BAND = 15, 3
SEED = 71_993
#: Rows and shingles of a block, on average; two blocks are compared in a task at a time.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 500_000

#: What tells one set from another: two sums over its shingles, and its size.
_SET = ["h1", "h2", "n_shingles"]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def shingle_sets(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, ascending within a text, and the borders between texts."""
    data, borders = joined(texts)
    data = LOWER[data]
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    begins = np.zeros(len(data) + 1, bool)
    begins[borders] = True
    before, after = np.ones(len(data) + 1, bool), np.ones(len(data) + 1, bool)
    before[1:] = blank
    after[:-1] = blank
    starts = np.flatnonzero(~blank & (before | begins)[:-1])
    ends = np.flatnonzero(~blank & (after | begins)[1:]) + 1
    hashes = range_hashes(data, starts, ends)
    counts = np.diff(np.searchsorted(starts, borders))
    shingles = np.zeros(len(hashes), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(words):
            factor = mix64(np.array([2 * i + 1], np.uint64)) | np.uint64(1)
            shingles[: max(len(hashes) - i, 0)] += hashes[i:] * factor
    first = np.cumsum(counts) - counts
    left = np.repeat(first + counts, counts) - np.arange(len(hashes))  # words up to the text's end
    short = np.flatnonzero((counts > 0) & (counts < words))
    for j in short.tolist():
        held = hashes[first[j] : first[j] + counts[j]].tobytes()
        shingles[first[j]] = range_hashes(np.frombuffer(held, np.uint8), np.array([0]), np.array([len(held)]), 7)[0]
    keep = left >= words
    keep[first[short]] = True
    values = mix64(shingles[keep])
    sizes = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    at = np.append(0, np.cumsum(sizes))
    sets = [np.unique(values[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return np.concatenate(sets) if sets else values, np.cumsum([0, *map(len, sets)])


def half_keys(values: np.ndarray, borders: np.ndarray, halves: int, band: int) -> np.ndarray:
    """The half keys of both collections (rows, 2 * halves); a row without values holds zeros."""
    full = np.flatnonzero(np.diff(borders))
    out = np.zeros((len(borders) - 1, 2 * halves), np.uint64)
    if not len(full):
        return out
    picks = np.random.default_rng(SEED).integers(0, 1 << 63, (2 * halves * band, 2), dtype=np.uint64)
    for k, (factor, shift) in enumerate(picks):
        least = np.minimum.reduceat(values * (factor * np.uint64(2) + np.uint64(1)) + shift, borders[full])
        out[full, k // band] = mix64(out[full, k // band] + least)
    return out


def placed_keys(halves: np.ndarray) -> np.ndarray:
    """The half keys made to differ by their place, so that keys of different places never meet."""
    return mix64(halves + mix64(np.arange(1, halves.shape[1] + 1, dtype=np.uint64)))


def _similar(a: Column, b: Column, percent: int) -> Column:
    common = F.size(F.array_intersect(a, b))
    return 100 * common >= percent * (F.size(a) + F.size(b) - common)


def block_links(group: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of different components, as far as they join different rows (each row, the least it reaches)."""
    ids, sides, parts = (group.column(name).to_numpy() for name in ("id", "own", "component"))
    lists = group.column("shingles").combine_chunks()
    borders = lists.offsets.to_numpy()
    values = lists.values.to_numpy()[borders[0] : borders[-1]]
    sizes = np.diff(borders)
    owner = np.repeat(np.arange(len(ids)), sizes)
    keys, which, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1  # only shingles of several rows count
    column, owner = shared[which[times[which] > 1]], owner[times[which] > 1]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((len(ids), len(ids)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        dense = np.zeros((len(ids), 4096), np.float32)
        dense[owner[a:b], column[a:b] - start] = 1
        common += dense @ dense.T
    near = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common.astype(np.float64))
    near &= parts[:, None] != parts[None, :]
    if group.column("apart")[0].as_py():
        near &= sides[:, None] != sides[None, :]
    order = np.argsort(ids)
    a, b = np.nonzero(np.triu(near[np.ix_(order, order)], 1))
    ids, reached = ids[order], forest(len(ids), a, b)
    moved = reached != np.arange(len(ids))
    return ids[moved], ids[reached[moved]]


def near_duplicates(
    docs: DataFrame,
    scratch: Scratch,
    words: int = WORDS,
    percent: int = PERCENT,
    halves: int = HALVES,
    band: int = BAND,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of (doc_id, text)."""
    reachable(docs.sparkSession)
    # The hash tells the rows of one doc_id apart where their texts are read again.
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("content"))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in text_blocks(batch.column(1)):
                values, borders = shingle_sets(texts, words)
                sums = [np.append(np.uint64(0), np.cumsum(mix64(values + np.uint64(seed)))) for seed in (1, 2)]
                marks = [pa.array((s[borders[1:]] - s[borders[:-1]]).view(np.int64)) for s in sums]
                keys = half_keys(values, borders, halves, band)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, len(texts)),
                        batch.column(2).slice(done, len(texts)),
                        pa.array(np.diff(borders), pa.int64()),
                        *marks,
                        binary_array(keys.ravel(), np.arange(len(texts) + 1) * 2 * halves),
                    ],
                    ["doc_id", "content", "n_shingles", "h1", "h2", "halves"],
                )
                done += len(texts)

    shape = "doc_id long, content long, n_shingles long, h1 long, h2 long, halves binary"
    rows = scratch.write(docs.mapInArrow(summed, shape), "rows")
    usable = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    sets = rows.where(usable)
    classes = sets.groupBy(*_SET).agg(F.min(F.struct("doc_id", "content")).alias("least"), F.first("halves").alias("halves"))
    classes = scratch.write(classes.withColumn("id", F.monotonically_increasing_id()), "classes")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.tile(np.arange(2 * halves) < halves, 1000)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                keys = placed_keys(np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint64).reshape(-1, 2 * halves))
                ids = part.column(0).take(pa.array(np.repeat(np.arange(len(keys)), 2 * halves)))
                columns = [pa.array(keys.ravel().view(np.int64)), pa.array(first[: keys.size]), ids]
                yield pa.RecordBatch.from_arrays(columns, ["half", "first", "id"])

    each = classes.select("id", "halves").mapInArrow(spread, "half long, first boolean, id long")
    several = each.groupBy("half").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    several = scratch.write(several.where("least <> most").select("half"), "shared-halves")
    shared = each.join(several, "half").groupBy("id")
    sides = [F.collect_list(F.when(side, F.col("half"))).alias(name) for name, side in (("ones", F.col("first")), ("others", ~F.col("first")))]
    shared = scratch.write(shared.agg(*sides).where("size(ones) > 0 AND size(others) > 0"), "halves")
    buckets = shared.select("id", F.explode("ones").alias("one"), "others").select("id", "one", F.explode("others").alias("other"))
    buckets = buckets.select(F.xxhash64("one", "other").alias("bucket"), "id")
    full = buckets.groupBy("bucket").agg(F.min("id").alias("hub"), F.count("*").alias("n")).where("n > 1")
    members = scratch.write(buckets.join(full, "bucket"), "members")

    needed = members.select("id").distinct().join(classes.select("id", "least"), "id")
    wanted = docs.join(needed.select("id", "least.doc_id", "least.content"), ["doc_id", "content"])

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in text_blocks(batch.column(1)):
                values, borders = shingle_sets(texts, words)
                out = [batch.column(0).slice(done, len(texts)), list_array(values.view(np.int64), borders, pa.int64())]
                yield pa.RecordBatch.from_arrays(out, ["id", "shingles"])
                done += len(texts)

    spells = wanted.select("id", "text").mapInArrow(spelled, "id long, shingles array<long>")
    spells = scratch.write(spells.groupBy("id").agg(F.first("shingles").alias("shingles")), "shingles")

    def verified(pairs: DataFrame) -> DataFrame:
        one = spells.select(F.col("id").alias("a"), F.col("shingles").alias("one"))
        two = spells.select(F.col("id").alias("b"), F.col("shingles").alias("two"))
        both = pairs.join(one, "a").join(two, "b")
        return both.where(_similar(F.col("one"), F.col("two"), percent)).select("a", "b")

    starred = members.where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    starred = scratch.write(starred, "starred")
    links = scratch.write(verified(starred), "hub-links")
    joined_up = components(links, scratch, "hub")

    # Buckets of two have been compared. The others may hold several components still.
    larger = members.where("n > 2").select("bucket", "id")
    placed = larger.join(joined_up.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    open_buckets = placed.join(mixed.where("least <> most").select("bucket"), "bucket")
    waiting = open_buckets.select("id", "component").distinct()
    opened = scratch.write(waiting.join(classes.select("id", "n_shingles", "halves"), "id"), "open")
    place = F.explode(F.sequence(F.lit(0), F.lit(halves - 1)))
    half = F.expr("substring(halves, 8 * place + 1, 8)")
    sides = opened.withColumn("place", place).select(
        F.xxhash64("place", half).alias("bucket"), "id", "n_shingles", "component"
    )
    sizes = sides.groupBy("bucket").agg(
        F.count("*").alias("n"),
        F.sum("n_shingles").alias("held"),
        F.min("component").alias("least"),
        F.max("component").alias("most"),
    )
    parts = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("held") / BLOCK_SHINGLES)).cast("int")
    sizes = sizes.where("least <> most").select("bucket", parts.alias("parts"))
    pairs = block_pairs(sides.select("bucket", "id").join(sizes, "bucket"))
    compared = pairs.join(opened.select("id", "component").join(spells, "id"), "id")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "block"):
            found = block_links(group, percent)
            if len(found[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["a", "b"])

    more = scratch.write(by_block(compared).mapInArrow(linked, "a long, b long"), "more-links")
    found = components(links.unionByName(more), scratch, "all") if more.count() else joined_up

    # A component is named by the smallest doc_id of its classes; a class without links by its own.
    linked_sets = classes.select(*_SET, "id", F.col("least.doc_id").alias("least")).join(found.withColumnRenamed("node", "id"), "id", "left")
    linked_sets = linked_sets.withColumn("component", F.coalesce("component", "id"))
    smallest = linked_sets.groupBy("component").agg(F.min("least").alias("component_id"))
    named = linked_sets.join(smallest, "component").select(*_SET, "component_id")
    out = sets.select("doc_id", *_SET).join(named, _SET).select("doc_id", "n_shingles", "component_id")
    alone = rows.where(~F.coalesce(usable, F.lit(False))).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, scratch: Scratch, **settings: int) -> DataFrame:
    """The documents that are kept, with all their columns.

    Rows that share a doc_id go only if none of them is kept, so no text is lost with another one of its id.
    """
    rows = near_duplicates(docs, scratch, **settings).where("doc_id IS NOT NULL")
    dropped = rows.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).where("NOT kept").select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)
