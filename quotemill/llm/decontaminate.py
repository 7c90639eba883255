"""Benchmark decontamination by spaced-seed hashing.

A seed is a mask over consecutive words: hashes of the kept positions agree even where ignored words differ.
The seeds of all benchmark items fill a Bloom filter of fixed size; training texts are streamed past it, and
only seeds that may be in the filter are joined with the benchmark's by hash. A hit names a diagonal, on which
words are then compared one by one: runs with few substitutions are overlaps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.folded import bloom_of, parted
from quotemill.llm.storage import fresh, kept, stored, working_tables
from quotemill.llm.tokens import Words, as_bytes, groups_of, int64_list, window_hashes


@dataclass(frozen=True)
class SpacedSeeds:
    #: Kept (1) and ignored (0) words of each mask. Every overlap that the other values accept holds one of these.
    masks: tuple[str, ...] = ("1110111", "11111", "111101", "11010011", "110111")
    #: An overlap has so many equal words, and so many of a hundred of its words are equal.
    min_equal: int = 10
    min_percent: int = 75
    #: Shorter items than min_equal words are overlaps as a whole, down to this length (that of the plain mask); still
    #: shorter ones are everywhere, and are overlaps only of texts that are nothing else.
    min_item: int = 5

    def offsets(self) -> list[tuple[int, ...]]:
        return [tuple(k for k, c in enumerate(m) if c == "1") for m in self.masks]


def seeds_of(words: Words, masks: SpacedSeeds) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions in the group, hashes) of each mask; no seed crosses from one text to the next."""
    last = np.repeat(words.bounds[1:], np.diff(words.bounds))
    for k, offsets in enumerate(masks.offsets()):
        if len(words.hashes) > offsets[-1]:
            hashes = window_hashes(words.hashes, offsets, salt=k + 1)
            at = np.flatnonzero(np.arange(len(hashes)) + offsets[-1] < last[: len(hashes)])
            yield at, hashes[at]
    # A text too short for any mask has one seed, all its words.
    lengths = np.diff(words.bounds)
    for n in range(1, masks.min_item):
        at = words.bounds[:-1][lengths == n]
        if len(at):
            yield at, window_hashes(words.hashes, tuple(range(n)), salt=len(masks.masks) + n)[at]


def _benchmark_tables(benchmark: DataFrame, masks: SpacedSeeds) -> tuple[DataFrame, DataFrame]:
    """(item_id, item, words) and (seed, item, q); ``item`` tells apart texts of one item_id."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["item_id"].to_pylist()
            for words in groups_of(as_bytes(batch["text"])):
                where = words.doc_of_word()
                by_item: list[tuple[list, list]] = [([], []) for _ in range(len(words))]
                for at, hashes in seeds_of(words, masks):
                    for p, h in zip(at.tolist(), hashes.view(np.int64).tolist(), strict=True):
                        d = where[p]
                        by_item[d][0].append(p - int(words.bounds[d]))
                        by_item[d][1].append(h)
                own = [words.hashes[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "item_id": pa.array(ids[words.first_row : words.first_row + len(words)], pa.int64()),
                        "words": int64_list(own),
                        "q": pa.array([x[0] for x in by_item], pa.list_(pa.int64())),
                        "seed": pa.array([x[1] for x in by_item], pa.list_(pa.int64())),
                    }
                )

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").dropDuplicates()
    found = items.mapInArrow(rows, "item_id long, words array<long>, q array<long>, seed array<long>")
    found = stored(found.withColumn("item", F.xxhash64("item_id", "words")), "bench-items")
    seeds = found.select("item", F.explode(F.arrays_zip("seed", "q")).alias("s")).select("s.seed", "item", "s.q")
    return found.select("item_id", "item", "words"), stored(seeds, "bench-seeds")


def _hits(documents: DataFrame, seeds: DataFrame, masks: SpacedSeeds) -> DataFrame:
    """(doc_id, doc, words, hits) of documents with a seed that the filter lets through."""
    shared = documents.sparkSession.sparkContext.broadcast(bloom_of(seeds.select("seed"), bits_per_key=32))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = shared.value
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            for words in groups_of(as_bytes(batch["text"])):
                at, hashes = [], []
                for p, h in seeds_of(words, masks):
                    keep = np.flatnonzero(filled.may_hold(h))
                    at.append(p[keep])
                    hashes.append(h[keep])
                if not at or not sum(map(len, at)):
                    continue
                at, hashes = np.concatenate(at), np.concatenate(hashes)
                doc = np.searchsorted(words.bounds, at, side="right") - 1
                for d in np.unique(doc):
                    own = doc == d
                    a, b = int(words.bounds[d]), int(words.bounds[d + 1])
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array([ids[words.first_row + int(d)]], pa.int64()),
                            "words": int64_list([words.hashes[a:b]]),
                            "p": pa.array([(at[own] - a).tolist()], pa.list_(pa.int64())),
                            "seed": pa.array([hashes[own].view(np.int64).tolist()], pa.list_(pa.int64())),
                        }
                    )

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = docs.mapInArrow(scan, "doc_id long, words array<long>, p array<long>, seed array<long>")
    return stored(found.withColumn("doc", F.xxhash64("doc_id", "words")), "bench-hits")


def best_overlap(equal: np.ndarray, percent: int) -> tuple[int, int]:
    """[start, end) of the run with the most equal words, ``percent`` of a hundred of its words or more; (0, 0) if none.

    An equal word counts 100 - percent and any other -percent, so that runs whose sum is 0 or more have enough equal
    words. From each end, the earliest start with no larger sum before it has the most; the first best run is taken.
    """
    if not equal.any():
        return 0, 0
    sums = np.concatenate(([0], np.cumsum(np.where(equal, 100 - percent, -percent))))
    words = np.concatenate(([0], np.cumsum(equal)))
    starts = np.searchsorted(-np.minimum.accumulate(sums), -sums)
    end = int((words - words[starts]).argmax())
    inside = np.flatnonzero(equal[starts[end] : end])
    return int(starts[end] + inside[0]), int(starts[end] + inside[-1]) + 1


def find_overlaps(documents: DataFrame, benchmark: DataFrame, masks: SpacedSeeds = SpacedSeeds()) -> DataFrame:
    """Overlaps of documents with benchmark items: one row for each document, item and diagonal that qualifies.

    Columns: doc_id, item_id, doc_word and item_word (first words, from 0), n_words, n_equal: of each diagonal the run
    with the most equal words. Words are split at ASCII white space after lower-casing A-Z. Null and empty texts
    overlap nothing, null ids stay null; an item of fewer than ``min_equal`` words must stand in the text as a whole,
    one of fewer than ``min_item`` words must be the whole text. Repeated rows give one row, as do repeated items; an empty
    table on either side gives an empty result; other columns are left out.
    """
    with working_tables(documents.sparkSession):
        return kept(_overlaps(documents, benchmark, masks), "bench-overlaps")


def _overlaps(documents: DataFrame, benchmark: DataFrame, masks: SpacedSeeds) -> DataFrame:
    items, seeds = _benchmark_tables(benchmark, masks)
    hits = _hits(documents, seeds, masks)
    placed = hits.select("doc", F.explode(F.arrays_zip("seed", "p")).alias("h")).select("doc", "h.seed", "h.p")
    diagonals = placed.join(seeds, "seed").select("doc", "item", (F.col("p") - F.col("q")).alias("diagonal")).distinct()
    texts = hits.select("doc", "doc_id", F.col("words").alias("d")).dropDuplicates(["doc"])
    pairs = diagonals.join(items.select("item", "item_id", F.col("words").alias("t")), "item").join(texts, "doc")
    # Only the words that stand opposite each other on the diagonal go on.
    start = F.greatest(F.col("diagonal"), F.lit(0))
    length = F.least(F.size("d") - start, F.size("t") - (start - F.col("diagonal"))).cast("int")
    opposite = pairs.select(
        "doc_id", "item_id", start.alias("p"), (start - F.col("diagonal")).alias("q"), F.size("t").alias("item_words"),
        F.slice("d", (start + 1).cast("int"), length).alias("d"),
        F.slice("t", (start - F.col("diagonal") + 1).cast("int"), length).alias("t"),
    )

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                equal = np.asarray(r.d) == np.asarray(r.t)
                a, b = best_overlap(equal, masks.min_percent)
                n = int(equal[a:b].sum())
                if n >= min(masks.min_equal, r.item_words):
                    rows.append((r.doc_id, r.item_id, r.p + a, r.q + a, b - a, n))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "doc_word", "item_word", "n_words", "n_equal"]).astype(
                {"doc_id": "Int64", "item_id": "Int64"}
            )

    schema = "doc_id long, item_id long, doc_word long, item_word long, n_words long, n_equal long"
    return opposite.mapInPandas(verify, schema).distinct()


def contaminated_items(documents: DataFrame, benchmark: DataFrame, masks: SpacedSeeds = SpacedSeeds()) -> DataFrame:
    """(doc_id, item_id, n_overlaps, n_equal, first_word): one row for each contaminated document and item.

    Rows of ``find_overlaps``, counted: null ids are one group, repeated rows and ties count once, texts without words
    and empty tables give no row.
    """
    found = find_overlaps(documents, benchmark, masks)
    return found.groupBy("doc_id", "item_id").agg(
        F.count("*").alias("n_overlaps"), F.max("n_equal").alias("n_equal"), F.min("doc_word").alias("first_word")
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame, masks: SpacedSeeds = SpacedSeeds()) -> DataFrame:
    """``documents`` without those whose text overlaps an item, whatever their ids; all columns are kept.

    Null and empty texts stay, repeated rows stay or go together, an empty table on either side changes nothing. Only
    rows that a Bloom filter of the overlapping texts lets through are shuffled.
    """
    bad_text, text = fresh(documents, "bad_text"), F.xxhash64("text")
    with working_tables(documents.sparkSession):
        found = find_overlaps(documents.select(text.alias("doc_id"), "text"), benchmark, masks)
        bad = kept(found.select(F.col("doc_id").alias(bad_text)).distinct(), "bench-bad")
    likely, others = parted(documents, text, bad)
    return others.union(likely.join(bad, text == F.col(bad_text), "left_anti"))
