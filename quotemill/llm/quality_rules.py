"""Quality rules: count rules plus divergence of a document from its language's reference histograms.

DataFrame functions only. Two histograms of a document (character classes; the commonest words of its
language) are compared with the same histograms of all documents of that language by Jensen-Shannon
distance. Documents shorter than ``min_words`` are left to the count rules.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quotemill.llm.storage import kept, stored, working_tables

# What separates words, and the symbols that the rules count.
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

# Character classes of the histogram, besides the symbols, bytes beyond one a character, the rest.
CLASSES = {"upper": "A-Z", "digit": "0-9", "space": r"\x20\x09-\x0D", "stop": r".,;:!?'\"()\-"}
N_CLASSES = 7


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 50
    max_repeat_percent: int = 50
    common_words: int = 24
    common_word_chars: int = 8
    #: Largest distances of a kept document; the allowance for short texts is noise / sqrt(n_words).
    max_class_distance: float = 0.26
    max_word_distance: float = 0.40
    noise: float = 0.3


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def repeated_window_words(words: Column, n: int = 3) -> Column:
    """How many words stand in an ``n``-word window that occurs at least twice in ``words``.

    Windows are compared by 64-bit hash; most texts repeat none, and only the others are sorted.
    """

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0)))
        hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]))
        return F.when(F.size(w) > n, hashed).otherwise(F.array().cast("array<bigint>"))

    def covered(s: Column) -> Column:
        starts = F.filter(
            F.transform(
                s,
                lambda x, k: F.when((x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["p"]),
            ),
            lambda p: p.isNotNull(),
        )
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda p: F.sequence(p, p + (n - 1))))))

    def counted(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, p: F.struct(x.alias("h"), p.alias("p"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(bind(placed, covered))

    return bind(words, lambda w: bind(windows(w), counted)).cast("long")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    with_words = F.filter(F.split(text, "\n"), lambda line: F.regexp_replace(line, SPACES, "") != "")
    return bind(with_words, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def with_class_counts(texts: DataFrame) -> DataFrame:
    """``texts`` with word_chars, n_symbols, class_total and ``classes``: characters in each class, bytes beyond one a character
    (accents, other scripts), all other characters.

    Counts are columns before they are an array, so that each is made once. Matches are counted, not replaced: the
    code that is generated for replacing five times in a row is too long to be compiled further by the JVM.
    """
    count = lambda chars: F.regexp_count("text", F.lit(f"[{chars}]"))
    own = {f"{k}_": count(chars) for k, chars in CLASSES.items()}
    counted = texts.withColumns(
        {"n_symbols": count(SYMBOLS), "chars_": F.length("text"), "wide_": F.octet_length("text") - F.length("text"), **own}
    )
    counted = counted.withColumn("word_chars", F.col("chars_") - F.col("space_"))
    known = [F.col("upper_"), F.col("digit_"), F.col("space_"), F.col("stop_"), F.col("n_symbols"), F.col("wide_")]
    rest = F.greatest(F.col("chars_") - reduce(lambda a, c: a + c, known), F.lit(0))
    classes = F.array(*[c.cast("double") for c in (*known, rest)])
    total = reduce(lambda a, c: a + c, known) + rest
    return counted.withColumns({"classes": classes, "class_total": total.cast("double")}).drop("chars_", "wide_", *own)


def shares(counts: Column) -> Column:
    """A histogram as shares of 1; all zero if it is empty."""
    def scaled(c: Column) -> Column:
        total = F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
        return bind(total, lambda t: F.transform(c, lambda x: F.when(t > 0, x / t).otherwise(F.lit(0.0))))

    return bind(counts, scaled)


def jensen_shannon(counts: Column, total: Column, q: Column) -> Column:
    """Jensen-Shannon distance (square root of the divergence in bits), 0 to 1, of ``counts`` as shares of ``total`` and
    the shares ``q``: the entropy of the mean histogram less the mean entropy of both."""
    bits = lambda x: F.when(x > 0, x * F.log2(x)).otherwise(F.lit(0.0))
    own = lambda c: c / F.greatest(total, F.lit(1.0))
    parts = F.zip_with(counts, q, lambda c, b: bits(own(c)) + bits(b) - 2.0 * bits((own(c) + b) / 2.0))
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x) / 2.0, F.lit(0.0)))


def language_references(documents: DataFrame, rules: QualityRules) -> DataFrame:
    """Per language (null: ''): class shares, its commonest words and their shares, over all documents.

    Sums are combined on the map side, so that a language with most rows is no hot key; of the word counts
    only the first ``common_words`` of each map task reach the ranking (window group limit).
    """
    text = F.coalesce("text", F.lit(""))
    docs = documents.select(F.coalesce("lang", F.lit("")).alias("ref_lang"), text.alias("text"))
    classes = with_class_counts(docs).select("ref_lang", F.col("classes").alias("c"))
    classes = classes.groupBy("ref_lang").agg(F.array(*[F.sum(F.col("c")[i]) for i in range(N_CLASSES)]).alias("c"))
    words = docs.select("ref_lang", F.explode(words_of(F.lower("text"))).alias("word"))
    short = F.length("word") <= rules.common_word_chars
    counts = words.groupBy("ref_lang", F.when(short, F.col("word")).alias("word")).agg(F.count("*").alias("n"))
    counts = stored(counts, "quality-words")  # read twice: for the commonest words and for the total
    ranked = (
        counts.where("word is not null")
        .withColumn("rank", F.row_number().over(W.partitionBy("ref_lang").orderBy(F.desc("n"), "word")))
        .where(F.col("rank") <= rules.common_words)
    )
    total = counts.groupBy("ref_lang").agg(F.sum("n").alias("total"))
    listed = ranked.groupBy("ref_lang").agg(
        F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("top"), F.sum("n").alias("in_top")
    )
    common = total.join(listed, "ref_lang", "left").select(
        "ref_lang",
        F.coalesce(F.col("top.word"), F.array().cast("array<string>")).alias("ref_words"),
        shares(
            F.concat(
                F.coalesce(F.transform("top", lambda x: x["n"].cast("double")), F.array().cast("array<double>")),
                F.array((F.col("total") - F.coalesce("in_top", F.lit(0))).cast("double")),
            )
        ).alias("ref_word_shares"),
    )
    return classes.select("ref_lang", shares(F.col("c")).alias("ref_class_shares")).join(common, "ref_lang", "left")


def apply_quality_rules(documents: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Rule counts, distances and verdict of every document; one row per input row.

    Null text counts as a text without words, and fails ``min_words``. A null language and an empty one are one
    language. Texts of fewer than ``min_words`` words have too small histograms: their distances are null. Ties and repeated rows are judged alike, other columns are left out, an empty table gives an empty
    result. Whole texts are judged.
    """
    with working_tables(documents.sparkSession):
        refs = kept(language_references(documents, rules), "quality-refs")
    text = F.coalesce("text", F.lit(""))
    docs = documents.select("doc_id", F.coalesce("lang", F.lit("")).alias("ref_lang"), text.alias("text"))
    words = with_class_counts(docs).withColumn("words", words_of(F.col("text")))
    counted = words.select(
        "doc_id",
        "ref_lang",
        "text",
        F.size("words").cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        "classes",
        "class_total",
        repeated_lines(F.col("text")).alias("n_dup_lines"),
        repeated_window_words(F.col("words")).alias("n_repeat_words"),
    )
    n = F.col("n_words")
    failed = (n < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * n)
    joined = counted.withColumn("base_failed", failed).join(refs, "ref_lang", "left")
    # Most words are none of the listed ones: they go first, and only the others are counted word by word.
    common = F.filter(words_of(F.lower("text")), lambda w: F.array_contains("ref_words", w))
    hits = bind(
        common,
        lambda w: F.transform("ref_words", lambda c: (F.size(w) - F.size(F.array_remove(w, c))).cast("double")),
    )
    rest = bind(hits, lambda h: F.concat(h, F.array(n.cast("double") - F.aggregate(h, F.lit(0.0), lambda a, x: a + x))))
    allowance = F.lit(rules.noise) / F.sqrt(F.greatest(n, F.lit(1)).cast("double"))
    guarded = lambda c: F.when(n >= rules.min_words, c)
    scored = joined.withColumns(
        {
            "class_distance": guarded(jensen_shannon(F.col("classes"), F.col("class_total"), F.col("ref_class_shares"))),
            "word_distance": guarded(jensen_shannon(rest, n.cast("double"), F.col("ref_word_shares"))),
        }
    )
    near = (F.col("class_distance") <= rules.max_class_distance + allowance) & (
        F.col("word_distance") <= rules.max_word_distance + allowance
    )
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & near).alias("kept"), "class_distance", "word_distance",
    )
