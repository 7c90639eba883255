"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Every source is cut, in a shuffled order of its documents, into blocks of equal token counts. The points
``i * golden ratio mod 1`` of a schedule fall into the sources' intervals of cumulative weight; the rank of a
slot among its source's slots says which block it takes, and in which pass over the source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quotemill.llm.storage import kept, stored, working_tables

# Fixed value: the fractional part of the golden ratio, in units of 2**-53.
GOLDEN = 5_566_755_282_872_655
SPACES = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mixture:
    #: Weights of the sources in the order of their names, repeating.
    weights: tuple[int, ...] = (1, 2, 3)
    #: A source's target stops at so many times its size.
    most_passes: int = 3
    block_words: int = 32
    seed: str = "mix"
    #: Parts of a source for running sums; slots of one window of the schedule; cells of the unit interval.
    parts: int = 4096
    chunk_slots: int = 65536
    cells: int = 1024


def n_words(text: Column) -> Column:
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")
    return F.size(words).cast("long")


def source_targets(sizes: DataFrame, mix: Mixture) -> DataFrame:
    """(source, source_size) -> also ``target``, ``n_blocks`` and the interval [lo, hi) of the schedule.

    Targets are min(most_passes * size, level * weight); the level at which they sum to all words follows
    from running sums over the sources in the order in which they would reach their limits. The rows here
    are one for each source.
    """
    by_name = W.orderBy(F.asc_nulls_last("source"))
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    named = sizes.withColumns(
        {
            "weight": F.get(weights, (F.row_number().over(by_name) - 1) % len(mix.weights)),
            "most": (mix.most_passes * F.col("source_size")).cast("double"),
            "place": F.row_number().over(by_name),
        }
    )
    filled = W.orderBy(F.col("most") / F.col("weight"), "place")
    levels = named.withColumns(
        {
            "level": (
                F.sum("source_size").over(W.partitionBy()).cast("double")
                - F.coalesce(F.sum("most").over(filled.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
            )
            / F.sum("weight").over(filled.rowsBetween(0, W.unboundedFollowing)),
        }
    )
    level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))).over(W.partitionBy())
    targets = levels.withColumn("target", F.least("most", level * F.col("weight"))).withColumn(
        "n_blocks", F.ceil(F.col("source_size") / F.lit(mix.block_words)).cast("long")
    )
    slots = F.when(F.col("source_size") > 0, F.col("n_blocks") * F.col("target") / F.col("source_size")).otherwise(0.0)
    up_to = F.sum("slots").over(W.orderBy("place").rowsBetween(W.unboundedPreceding, 0))
    every = F.sum("slots").over(W.partitionBy())
    return (
        targets.withColumn("slots", slots)
        .withColumns({"hi_slots": up_to, "all_slots": every})
        .select(
            "source", "source_size", "target", "n_blocks", "place", "all_slots",
            F.try_divide(F.col("hi_slots") - F.col("slots"), F.col("all_slots")).alias("lo"),
            F.try_divide("hi_slots", "all_slots").alias("hi"),
        )
    )


def golden_point(slot: Column) -> Column:
    """The fraction of ``slot`` times the golden ratio: exact 53-bit integers, so that far slots are as even as the first.

    The product modulo 2**53 is made of parts that fit into 63 bits; for slots below 2**52.
    """
    a, b = F.shiftright(slot, 26), slot.bitwiseAND((1 << 26) - 1)
    high, low = GOLDEN >> 27, GOLDEN & ((1 << 27) - 1)
    product = b * low + F.shiftleft((b * high).bitwiseAND((1 << 26) - 1), 27) + F.shiftleft((a * low).bitwiseAND((1 << 27) - 1), 26)
    return product.bitwiseAND((1 << 53) - 1) / F.lit(float(1 << 53))


def schedule(targets: DataFrame, mix: Mixture) -> DataFrame:
    """Slots in order: (slot, place, pass_no, block). One row for each block that the mix takes."""
    spark = targets.sparkSession
    row = targets.agg(F.max("all_slots").alias("n")).first()
    n_slots = round(row["n"] or 0)
    tasks = max(1, min(n_slots // mix.chunk_slots + 1, 100_000))
    slots = spark.range(0, n_slots, 1, tasks).select(F.col("id").alias("slot"))
    slots = slots.withColumn("u", golden_point(F.col("slot"))).withColumn("cell", F.floor(F.col("u") * mix.cells))
    touched = F.sequence(
        F.floor(F.col("lo") * mix.cells), F.least(F.floor(F.col("hi") * mix.cells), F.lit(mix.cells - 1))
    )
    spans = targets.where("hi > lo").select("place", "n_blocks", "lo", "hi", F.explode(touched).alias("cell"))
    last = F.col("place") == F.lit(spans.agg(F.max("place")).first()[0])
    inside = (F.col("u") >= F.col("lo")) & ((F.col("u") < F.col("hi")) | last)
    dealt = slots.join(spans, "cell").where(inside).withColumn("chunk", F.floor(F.col("slot") / mix.chunk_slots))
    dealt = stored(dealt.select("slot", "chunk", "place", "n_blocks"), "mix-slots")
    before = dealt.groupBy("place", "chunk").agg(F.count("*").alias("n")).select(
        "place",
        "chunk",
        (F.sum("n").over(W.partitionBy("place").orderBy("chunk")) - F.col("n")).alias("before"),
    )
    in_chunk = F.row_number().over(W.partitionBy("place", "chunk").orderBy("slot")) - 1
    ranked = dealt.withColumn("rank", in_chunk).join(before, ["place", "chunk"])
    rank = F.col("before") + F.col("rank")
    return ranked.select(
        "slot",
        "place",
        F.floor(rank / F.col("n_blocks")).alias("pass_no"),
        (rank % F.col("n_blocks")).alias("block"),
    ).where(F.col("pass_no") < mix.most_passes)


def laid_out(documents: DataFrame, mix: Mixture) -> DataFrame:
    """Documents as (doc_id, source, key, size, row): sized, with the place in the source's shuffled order."""
    key = F.md5(F.concat_ws("|", F.lit(mix.seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    sized = documents.select("doc_id", "source", n_words(F.col("text")).alias("size"), key.alias("key"))
    part = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % mix.parts
    return stored(sized.withColumn("part", part), "mix-docs")


def mix_sources(documents: DataFrame, mix: Mixture = Mixture()) -> DataFrame:
    """What the mix takes of every document: doc_id, size, source_size, target, taken, passes.

    A null text has size 0, null is a source of its own and the last one, a null id is shuffled like any
    other value; rows that repeat each count; an empty table gives an empty result, and a table without words
    takes none. Reruns agree: the shuffled order is a hash of the id, equal ids go by size. Blocks cut
    documents, so that ``taken`` counts words, and no document is taken more than ``most_passes`` times.
    """
    with working_tables(documents.sparkSession):
        docs = laid_out(documents, mix)
        sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
        targets = stored(source_targets(sizes, mix), "mix-targets")
        place = targets.select(F.col("source").alias("of"), "place", "source_size", "target", "n_blocks")
        named = docs.join(place, F.col("source").eqNullSafe(F.col("of"))).drop("of")
        within = W.partitionBy("place", "part").orderBy("key", "size").rowsBetween(W.unboundedPreceding, 0)
        parts = named.groupBy("place", "part").agg(F.sum("size").alias("in_part"))
        ahead = W.partitionBy("place").orderBy("part").rowsBetween(W.unboundedPreceding, 0)
        parts = parts.select("place", "part", (F.sum("in_part").over(ahead) - F.col("in_part")).alias("ahead"))
        spans = (
            named.withColumn("start", F.sum("size").over(within) - F.col("size"))
            .join(parts, ["place", "part"])
            .withColumn("start", F.col("start") + F.col("ahead"))
            .drop("part", "ahead", "key")
        )
        spans = kept(spans, "mix-spans")
        taken = kept(schedule(targets, mix).groupBy("place", "block").agg(F.count("*").alias("times")), "mix-taken")
    base = ["doc_id", "source", "size", "source_size", "target", "place", "start"]

    # Block b of a source of n blocks holds the words from floor(b * size / n) to floor((b + 1) * size / n).
    def block_at(word: Column) -> Column:
        return F.floor(((word + 1) * F.col("n_blocks") - 1) / F.col("source_size"))

    pieces = spans.where("size > 0").select(
        *base,
        "n_blocks",
        F.explode(F.sequence(block_at(F.col("start")), block_at(F.col("start") + F.col("size") - 1))).alias("block"),
    )
    edge = lambda b: F.floor(b * F.col("source_size") / F.col("n_blocks"))
    overlap = F.least(F.col("start") + F.col("size"), edge(F.col("block") + 1)) - F.greatest(
        F.col("start"), edge(F.col("block"))
    )
    used = (
        pieces.join(taken, ["place", "block"], "left")
        .groupBy(*base)
        .agg(F.sum(overlap * F.coalesce("times", F.lit(0))).cast("long").alias("taken"))
    )
    empty = spans.where("size = 0").select(*base, F.lit(0).cast("long").alias("taken"))
    out = used.unionByName(empty)
    return out.select("doc_id", "source", "size", "source_size", "target", "taken")
