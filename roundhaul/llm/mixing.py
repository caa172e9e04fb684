"""Mixing sources to target weights: repetition rates for each source, whole copies plus one by chance.

Every source gets a share of the wanted words in proportion to its weight, but at most `most` times
its own size; what it cannot take is shared out again by weight among the others. A document is
then emitted floor(rate) times, and once more with a probability equal to the fraction, drawn
from a hash of its id: reruns and retried tasks emit the same copies.

All of it is native expressions. Texts are read once for their sizes; sizes are summed before they
are shuffled, so a source with a third of all rows costs no more than any other; the table of
sources is ranked in ranges, never in one task.

A NULL text has size 0, a NULL source is a source of its own and comes last. Documents without words
are emitted like all others of their source; a source without any word has the rate 0. Rows that repeat
are documents of their own, drawn alike; rows without an id are drawn by their source and size. An
empty table gives no rows. Only the id, the source and the text are looked at; `emitted` keeps all
other columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roundhaul.llm.common import Scratch

#: How often a document may be taken, and the weights that sources get in turn.
MOST = 3
WEIGHTS = (1, 2, 3)
SEED = 20_240
#: Up to so many bytes the table of sources is broadcast; beyond, sources are joined in `SALTS` parts each.
BROADCAST_BYTES = 16 * 1024**2
SALTS = 64

# The six white-space characters of ASCII, as a regular expression's class and as characters.
BLANK, BLANKS = r"\x20\x09-\x0D", " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Words of a text, 0 for NULL: each becomes one letter, so that no list of them is made."""
    trimmed = F.rtrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.char_length(F.regexp_replace(trimmed, rf"[{BLANK}]*+[^{BLANK}]++", "w")).cast("long")


def chance(seed: int, *key: Column) -> Column:
    """A number from 0 up to 1 that depends on the key alone: 52 bits of a digest."""
    told = F.concat_ws(":", F.lit(f"mix {seed}"), *key)
    return F.conv(F.substring(F.md5(told), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def sizes(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, source and size of every document, written: the one pass over the texts."""
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    return scratch.write(rows, "sizes")


def _ranked(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """The sources with `place`, from 0 in order of code points, NULL last.

    They are dealt by range and numbered within their range; written down, so that the ranges
    stay what they are. Only one row a range meets in one task.
    """
    order = F.col("source").asc_nulls_last()
    ranges = sources.repartitionByRange(order).withColumn("range", F.spark_partition_id())
    ranges = scratch.write(ranges, "ranges")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranges.groupBy("range").agg(F.count("*").alias("n"))
    starts = counts.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("range").orderBy(order)) - 1
    return ranges.withColumn("within", within).join(starts, "range").select("source", "size", (F.col("start") + F.col("within")).alias("place"))


def rates(
    sized: DataFrame,
    scratch: Scratch,
    weights: Sequence[int] | DataFrame = WEIGHTS,
    most: int = MOST,
    words: int | None = None,
) -> DataFrame:
    """source, size, weight, target and rate of each source in the rows of `sizes`.

    `weights` are given to the sources in turn by code point, or are a table (source, weight) of
    whole numbers above 0, in which a source that is missing takes nothing. `words` are wanted in
    all, by default as many as there are.

    A round holds every source whose share is above its limit at that limit and shares the rest
    anew. The held sources only grow in number, so rounds end; what the driver sees of each is two sums.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("size"))
    if isinstance(weights, DataFrame):
        given = weights.select(F.col("source").cast("string").alias("for"), F.col("weight").cast("long").alias("weight"))
        sources = sources.join(given, F.col("source").eqNullSafe(F.col("for")), "left").drop("for")
        sources = sources.withColumn("weight", F.coalesce("weight", F.lit(0).cast("long")))
    else:
        turn = F.pmod("place", F.lit(len(weights))).cast("int")
        given = F.array(*[F.lit(int(w)).cast("long") for w in weights])
        sources = _ranked(sources, scratch).select("source", "size", F.get(given, turn).alias("weight"))
    sources = scratch.write(sources, "sources")
    limit = F.lit(most) * F.col("size")
    whole = sources.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    wanted = (whole["size"] or 0) if words is None else words
    held, weight = 0, whole["weight"] or 0
    while True:
        share = (F.col("weight") * F.lit(wanted - held)).cast("double") / F.lit(float(weight or 1))
        above = (share > limit) if weight else F.lit(True)
        found = sources.agg(
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if (found["held"], found["weight"]) == (held, weight):
            break
        held, weight = found["held"], found["weight"]
    target = F.when(F.col("weight") == 0, F.lit(0.0)).otherwise(F.least(limit.cast("double"), share) if weight else limit.cast("double"))
    rate = F.when(F.col("size") > 0, F.least(target / F.col("size"), F.lit(float(most)))).otherwise(0.0)
    return sources.select("source", "size", "weight", target.alias("target"), rate.alias("rate"))


def _by_source(rows: DataFrame, source: Column, key: Column, found: DataFrame) -> DataFrame:
    """Each row with its source's figures under `mix`; rows whose source has none are kept.

    A small table of sources goes to every executor; its bytes are summed first. A larger one is
    joined in parts of each source, so that no source meets in one task.
    """
    held = found.agg(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 64).alias("bytes")).first()["bytes"] or 0
    figures = found.select(F.col("source").alias("_of"), F.struct("size", "weight", "target", "rate").alias("_mix"))
    rows = rows.withColumn("_source", source)
    if held <= BROADCAST_BYTES:
        return rows.join(F.broadcast(figures), F.col("_source").eqNullSafe(F.col("_of")), "left")
    parts = figures.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int"))
    return rows.join(parts, F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_salt") == F.col("_part")), "left")


def _copies(rate: Column, draw: Column) -> Column:
    """Whole copies, and one more if the draw is below the fraction."""
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("int")).cast("int")


def _draw(doc_id: Column, source: Column, size: Column, seed: int) -> Column:
    unknown = F.concat_ws(":", F.lit("no id"), source, size.cast("string"))
    return chance(seed, F.coalesce(doc_id.cast("string"), unknown))


def copies(sized: DataFrame, found: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, rate and copies of every document."""
    rows = _by_source(sized, F.col("source"), F.col("doc_id"), found)
    draw = _draw(F.col("doc_id"), F.col("source"), F.col("size"), seed)
    return rows.select(
        "doc_id",
        "source",
        "size",
        F.col("_mix.size").alias("source_size"),
        F.col("_mix.target").alias("target"),
        F.col("_mix.rate").alias("rate"),
        _copies(F.col("_mix.rate"), draw).alias("copies"),
    )


def emitted(docs: DataFrame, found: DataFrame, seed: int = SEED, copy: str = "copy") -> DataFrame:
    """The mix itself: each document as often as it is taken, with all its columns and the number of the copy from 1.

    A column that is named like `copy` gives way to it.
    """
    kept = [name for name in docs.columns if name != copy]
    packed = docs.select(F.struct(*[F.col(f"`{name}`") for name in kept]).alias("_doc"))
    source = F.col("_doc.source").cast("string")
    rows = _by_source(packed, source, F.col("_doc.doc_id"), found)
    draw = _draw(F.col("_doc.doc_id"), source, word_count(F.col("_doc.text")), seed)
    times = _copies(F.col("_mix.rate"), draw)
    rows = rows.withColumn("_times", times).where("_times > 0")
    return rows.select("_doc", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_copy")).select(
        *[F.col("_doc").getField(name).alias(name) for name in kept], F.col("_copy").alias(copy)
    )
