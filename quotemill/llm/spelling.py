"""Spelling variants: words one edit apart, by PartEnum signatures of their letters.

A word's letters are a multiset, and so a binary vector: an element is a letter and its how-maniest occurrence. One
inserted or deleted letter changes one element, a replaced one two, so that words one edit apart are vectors with a
Hamming distance of at most two. PartEnum: the elements are dealt to ``parts`` first-level parts, and one of those
differs in at most ``distance // parts`` elements; each is dealt to ``subparts`` parts again, and all ways of leaving out
so many of them are enumerated. What a way keeps is an exact signature, and similar vectors share one.
Words with equal letters are one vector; vectors that share a signature are equi-joined, and their words verified.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quotemill.llm.joins import dealt_pairs, spread_join
from quotemill.llm.storage import kept, stored, working_tables

# What a run of letters is, and the letters that are lower-cased.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Spelling:
    least_letters: int = 7
    least_uses: int = 2
    #: A form is used so many times as often as the word.
    times: int = 10
    #: One of so many runs loses a letter.
    damaged: int = 31
    #: First-level parts, second-level parts of each, and the largest Hamming distance of two similar vectors.
    parts: int = 1
    subparts: int = 6
    distance: int = 2
    #: Words with equal letters that are one row; rows of a signature that one task pairs.
    group_words: int = 256
    signature_rows: int = 2048
    salts: int = 8


def used_words(documents: DataFrame, spelling: Spelling) -> DataFrame:
    """(word, n): the words of all texts and how often they are used, after runs have lost the letter they lose."""
    runs = F.filter(F.regexp_extract_all("text", F.lit(RUN), F.lit(0)), lambda w: F.length(w) >= spelling.least_letters)
    rows = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run"))
    rows = rows.select("doc", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    place = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    words = rows.select(F.when(h % spelling.damaged == 0, cut).otherwise(F.col("run")).alias("word"))
    counts = words.where(F.length("word") >= spelling.least_letters).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= spelling.least_uses)


def vector_of(letters: str) -> list[tuple[str, int]]:
    """The elements of a word's vector: each letter with its how-maniest occurrence."""
    seen: Counter[str] = Counter()
    out = []
    for letter in letters:
        seen[letter] += 1
        out.append((letter, seen[letter]))
    return out


def signatures(vector: list[tuple[str, int]], spelling: Spelling) -> list[int]:
    """PartEnum signatures: of each first-level part, what each way of leaving out second-level parts keeps."""
    dealt: list[list[str]] = [[] for _ in range(spelling.parts * spelling.subparts)]
    for letter, k in sorted(vector):
        dealt[xxhash.xxh32_intdigest(f"{letter}{k}".encode(), seed=3) % len(dealt)].append(f"{letter}{k}")
    out = []
    for part in range(spelling.parts):
        subparts = dealt[part * spelling.subparts : (part + 1) * spelling.subparts]
        for ways in combinations(range(spelling.subparts), spelling.subparts - spelling.distance // spelling.parts):
            kept_elements = "/".join(",".join(subparts[k]) for k in ways)
            out.append(np.uint64(xxhash.xxh3_64_intdigest(f"{part} {ways} {kept_elements}".encode())).view(np.int64))
    return out


def bits_of(vector: list[tuple[str, int]]) -> tuple[int, int]:
    """128 bits in which each element sets one: the bits of two vectors differ in no more places than they do."""
    words = [0, 0]
    for letter, k in vector:
        place = xxhash.xxh32_intdigest(f"{letter}{k}".encode(), seed=5) % 128
        words[place // 64] |= 1 << place % 64
    return tuple(int(np.uint64(w).view(np.int64)) for w in words)


def _vectors(words: DataFrame, spelling: Spelling) -> DataFrame:
    """(group, letters, held, low, high, signature): a row for each signature of each group of words with equal letters."""
    letters = F.array_join(F.array_sort(F.split("word", "")), "")
    placed = words.withColumn("letters", letters)
    nth = F.row_number().over(W.partitionBy("letters").orderBy("word"))
    placed = placed.withColumn("chunk", F.floor((nth - 1) / spelling.group_words))
    groups = placed.groupBy("letters", "chunk").agg(F.collect_list(F.struct("word", "n")).alias("held"))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [vector_of(x) for x in batch["letters"].to_pylist()]
            low, high = zip(*(bits_of(v) for v in vectors), strict=True) if vectors else ((), ())
            new = {"low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64())}
            new["signatures"] = pa.array([signatures(v, spelling) for v in vectors], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict({"letters": batch["letters"], "chunk": batch["chunk"], "held": batch["held"]} | new)

    kind = "letters string, chunk long, held array<struct<word string, n long>>, low long, high long, signatures array<long>"
    rows = groups.mapInArrow(signed, kind).withColumn("signature", F.explode("signatures"))
    return rows.select(F.xxhash64("letters", "chunk").alias("group"), "held", "low", "high", "signature")


def near_words(words: DataFrame, spelling: Spelling = Spelling()) -> DataFrame:
    """(word, n, other, other_n), in both directions: words (word, n) with exactly one letter inserted, deleted or replaced."""
    rows = stored(_vectors(words, spelling), "spelling-vectors")
    apart = lambda c: F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b")))
    pairs = dealt_pairs(rows, "signature", "group", spelling.signature_rows).where(apart("low") + apart("high") <= spelling.distance)
    one = pairs.select(F.inline("held_a").alias("word", "n"), "held_b")
    both = one.select("word", "n", F.inline("held_b").alias("other", "other_n"))
    near = both.where(F.levenshtein("word", "other", 1) == 1).distinct()
    near = stored(near, "spelling-near")
    return near.union(near.select("other", "other_n", "word", "n"))


def _rooted(forms: DataFrame, spelling: Spelling) -> DataFrame:
    """(word, root) of the words that have a form: the last one that forms lead to.

    Each turn doubles the steps taken. A form is used at least ``times`` times as often as its word, so chains are
    short and have no end in themselves.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(spread_join(reached, onward, "root", spelling.salts, "left"), "spelling-roots")
        if moved.where("next is not null").isEmpty():
            return reached
        reached = moved.select("word", F.coalesce("next", "root").alias("root"))


def _most_used(n: Column, word: Column) -> Column:
    """Of several words the one used most; of those the first in code-point order."""
    return F.min(F.struct((-n).alias("n"), word.alias("word")))


def spelling_variants(documents: DataFrame, spelling: Spelling = Spelling()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts: its nearest form and the root of its group.

    A word's form is the near word used most, if that is at least ``times`` times as often; its root is the last word
    that forms lead to, or itself. Null and empty texts have no words; a null doc_id counts as an empty one where
    runs lose letters; repeated rows count as often as they stand. Letters are taken as they are: only A-Z is
    lower-cased, and accents are not composed. Other columns are left out; an empty table gives an empty result.
    """
    with working_tables(documents.sparkSession):
        words = stored(used_words(documents, spelling), "spelling-words")
        near = near_words(words, spelling)
        best = near.groupBy("word").agg(F.count("*").alias("n_near"), _most_used(F.col("other_n"), F.col("other")).alias("best"))
        found = words.join(best, "word", "left")
        strong = -F.col("best.n") >= spelling.times * F.col("n")
        found = found.select(
            "word",
            F.when(strong, F.col("best.word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, -F.col("best.n")).alias("form_n"),
        )
        found = stored(found, "spelling-forms")
        roots = _rooted(found.where("form is not null"), spelling)
        rows = found.join(roots, "word", "left")
        return kept(rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "spelling-variants")
