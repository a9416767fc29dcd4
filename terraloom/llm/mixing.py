"""Mixing sources to target weights, in DataFrame operations only.

1. Sources (by code point, null last) weigh 1, 2, 3, repeating. Targets share the words of
   all documents by weight, each capped at three times its source's words; the common level
   of the uncapped ones is read off running sums over the sources in order of cap / weight.
2. A source's documents are put in hash order and their words cut into equal-token blocks
   (of ``block`` words; small sources into 64 blocks at least, as far as they have words).
   A target is a whole number of blocks, three times the source's number at most, so no
   document is taken more than three times.
3. The schedule's slots are points of the golden-ratio sequence, mapped through the
   cumulative shares of the sources; slots are ranked within their source, those beyond a
   source's number are left out, and a source that the points fell short of gets its missing
   slots at the end. Slot r of a source takes its block r modulo the number of blocks.

Running sums and ranks are made in two levels (hash ranges of a source, chunks of slots), so
that a source with most of the rows is dealt over many tasks. The order is a function of the
rows alone, so reruns agree. Null texts and texts without words have size 0 and are taken 0
times; equal rows count separately.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import Scratch

#: floor(2**32 / golden ratio): multiples of it modulo 2**32 are the golden-ratio sequence in fixed point.
GOLDEN = 2654435769


@dataclass(frozen=True)
class MixParams:
    block: int = 128  # words
    least_blocks: int = 64  # of a source, if it has as many words
    cap: int = 3  # times a source's words that the mix may take
    cycle: int = 3  # weights are 1..cycle, repeating
    chunk: int = 16384  # slots ranked together
    ranges: int = 4096  # hash ranges of a source's documents
    cells: int = 1024  # of the grid through which points find their source


def words(text: Column) -> Column:
    """Number of runs of characters other than space and TAB..CR; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, p: MixParams = MixParams()) -> DataFrame:
    """(src, source, source_size, target, blocks, quota) from (source, size): one row for each source."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by = by.withColumn("src", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    by = by.withColumn("weight", (F.col("src") - 1) % p.cycle + 1).withColumn("limit", F.col("source_size") * float(p.cap))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "src")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    by = by.withColumn("level", level)
    # Of the sources that stay below their cap at the level computed for them, the first has the level that holds for all.
    by = by.withColumn("level", F.max(F.when(F.col("level") <= F.col("limit") / F.col("weight"), F.col("level"))).over(whole))
    target = F.least("limit", F.coalesce(F.col("level"), F.lit(float("inf"))) * F.col("weight"))
    size = F.col("source_size")
    blocks = F.greatest(F.round(size / p.block).cast("long"), F.least(size, F.lit(p.least_blocks)), F.lit(1).cast("long"))
    by = by.withColumn("target", target).withColumn("blocks", blocks)
    quota = F.when(size > 0, F.least(F.round(F.col("target") * F.col("blocks") / size).cast("long"), F.col("blocks") * p.cap)).otherwise(F.lit(0).cast("long"))
    return by.withColumn("quota", quota).select("src", "source", "source_size", "target", "blocks", "quota")


def place_documents(docs: DataFrame, sources: DataFrame, p: MixParams) -> DataFrame:
    """docs (doc_id, source, size, t: hash of the text, which spreads rows of one id or none) with src and ``at``, the first word's position in the source's shuffled stream."""
    d = docs.join(sources.select("src", F.col("source").alias("__s")), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    d = d.withColumn("h", F.xxhash64("doc_id", "t", F.lit(17))).withColumn("range", F.pmod(F.shiftright("h", 32), F.lit(p.ranges)))
    sums = d.groupBy("src", "range").agg(F.sum("size").alias("n"))
    base = sums.withColumn("base", F.sum("n").over(Window.partitionBy("src").orderBy("range")) - F.col("n")).drop("n")
    own = Window.partitionBy("src", "range").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("upto", F.sum("size").over(own)).join(base, ["src", "range"])
    return d.select("doc_id", "source", "size", "src", (F.col("base") + F.col("upto") - F.col("size")).alias("at"))


def schedule(sources: DataFrame, slots: int, p: MixParams) -> DataFrame:
    """(slot, src, block): which source each slot of the mix draws on, and which of its blocks."""
    spark = sources.sparkSession
    upto = F.sum("quota").over(Window.orderBy("src"))
    share = sources.where("quota > 0").withColumn("hi", upto / float(slots)).withColumn("lo", (upto - F.col("quota")) / float(slots))
    grid = share.select("src", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") * p.cells), F.least(F.floor(F.col("hi") * p.cells), F.lit(p.cells - 1)))).alias("cell"))
    point = F.pmod(F.pmod(F.col("id"), F.lit(1 << 31)) * F.lit(GOLDEN), F.lit(1 << 32)) / float(1 << 32)
    drawn = spark.range(slots).select(F.col("id").alias("slot"), point.alias("u")).withColumn("cell", F.floor(F.col("u") * p.cells))
    drawn = drawn.join(grid, "cell").where((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi"))).select("slot", "src", F.floor(F.col("slot") / p.chunk).alias("chunk"))
    counts = drawn.groupBy("src", "chunk").agg(F.count("*").alias("n"))
    base = counts.withColumn("base", F.sum("n").over(Window.partitionBy("src").orderBy("chunk")) - F.col("n")).drop("n")
    rank = F.row_number().over(Window.partitionBy("src", "chunk").orderBy("slot")) - 1
    ranked = drawn.withColumn("r", rank).join(base, ["src", "chunk"]).select("slot", "src", (F.col("r") + F.col("base")).alias("r"))
    got = counts.groupBy("src").agg(F.sum("n").alias("got"))
    short = sources.join(got, "src", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < quota")
    more = short.select("src", F.explode(F.sequence("got", F.col("quota") - 1)).alias("r")).select((F.col("r") + slots).alias("slot"), "src", "r")
    plan = ranked.join(sources.select("src", "blocks", "quota"), "src").where("r < quota").select("slot", "src", "r", "blocks")
    plan = plan.unionByName(more.join(sources.select("src", "blocks"), "src"))
    return plan.select("slot", "src", (F.col("r") % F.col("blocks")).alias("block"))


def _first_word(block: Column) -> Column:
    """Position of a block's first word: the first ``extra`` blocks hold one word more than the others."""
    return block * F.col("each") + F.least(block, F.col("extra"))


def _whole(a: Column, b: Column) -> Column:
    """Integer division of non-negative longs."""
    return ((a - a % b) / b).cast("long")


def _block_of(word: Column) -> Column:
    longer = F.col("extra") * (F.col("each") + 1)
    return F.when(word < longer, _whole(word, F.col("each") + 1)).otherwise(F.col("extra") + _whole(word - longer, F.col("each")))


def mix(placed: DataFrame, sources: DataFrame, slots: int, p: MixParams) -> DataFrame:
    """(slot, src, doc_id, at, first, length): the mix, slot by slot, as pieces of documents (first: word offset in the document)."""
    s = sources.select("src", "source_size", "blocks").withColumn("each", F.expr("source_size div blocks")).withColumn("extra", F.col("source_size") % F.col("blocks"))
    d = placed.where("size > 0").join(s, "src")
    d = d.withColumn("block", F.explode(F.sequence(_block_of(F.col("at")), _block_of(F.col("at") + F.col("size") - 1))))
    first = F.greatest("at", _first_word(F.col("block")))
    end = F.least(F.col("at") + F.col("size"), _first_word(F.col("block") + 1))
    pieces = d.select("src", "block", "doc_id", "at", (first - F.col("at")).alias("first"), (end - first).alias("length"))
    return schedule(sources, slots, p).join(pieces, ["src", "block"]).select("slot", "src", "doc_id", "at", "first", "length")


def mix_report(docs: DataFrame, p: MixParams = MixParams(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken), one row for each row of docs."""
    tmp = Scratch(docs.sparkSession, "mixing")
    sizes = tmp.write(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("t")), "sizes")
    sources = tmp.write(source_targets(sizes, p), "sources")
    placed = tmp.write(place_documents(sizes, sources, p), "placed")
    tmp.drop("sizes")
    slots = sources.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    taken = mix(placed, sources, slots, p).groupBy("src", "at").agg(F.sum("length").alias("taken")) if slots else None
    facts = sources.select("src", "source_size", "target")
    out = placed.join(F.broadcast(facts) if sources.count() <= 10_000 else facts, "src")
    if taken is None:
        return out.select("doc_id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    out = out.join(taken.withColumn("__any", F.lit(True)), ["src", "at"], "left")
    got = F.when((F.col("size") > 0) & F.col("__any"), F.col("taken")).otherwise(F.lit(0)).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", got.alias("taken"))
