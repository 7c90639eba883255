"""Line dedup by a suffix array over the sequences of line numbers, built by distributed prefix doubling.

Round k ranks every suffix by its first 2**k lines, from sorted pairs of the ranks of round k - 1; suffixes whose
rank is unique are done and leave the rounds. Two ranks that overlap name the first n lines of a suffix for any n:
the suffixes that share them are the interval of the suffix array whose longest common prefix is n lines or more,
that is a repeated run of lines. The first copy of a run stays, the later ones are deleted.

Every repeated run with ``min_words`` words is deleted, of any length, by its shortest parts: each line of it is in
the shortest run with so many words that ends at that line, or in the one that starts where the run starts. Both
lie within the run and are repeated with it, and have ``min_words`` lines at most, as each line has a word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quotemill.llm.folded import parted
from quotemill.llm.storage import fresh, kept, stored, working_tables

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class LineRuns:
    #: Words that a run needs; shorter ones are common by chance.
    min_words: int = 10


def line_words(line: Column) -> Column:
    return F.size(F.array_remove(F.split(line, SPACES), "")).cast("long")


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc", "line")


def _ranked(suffixes: DataFrame, by: list[str], label: str) -> DataFrame:
    """The shared ranks: of each key that several suffixes have, its order.

    Counts are combined on the map side; the sorted distinct keys get increasing numbers, which keep their order
    over all partitions. Nothing is gathered for a key.
    """
    classes = suffixes.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return stored(classes.orderBy(*by).withColumn("rank", F.monotonically_increasing_id()), label)


def lines_with_words(text: Column) -> Column:
    """An array of (line, content): the lines that have words, each with its number among all lines, from 0."""
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.cast("long").alias("line"), x.alias("content")))
    return F.filter(lines, lambda x: x["content"].rlike(WORD))


def _shortest(lines: Column, words: int) -> Column:
    """How many of ``lines``, neighbours from the first on, have ``words`` words first; null if all have fewer."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("words"))

    def step(acc: Column, x: Column) -> Column:
        goes_on = (acc["words"] < words) & (F.abs(x["at"] - lines[0]["at"]) == acc["n"])
        return F.when(goes_on, F.struct((acc["n"] + 1).alias("n"), (acc["words"] + x["words"]).alias("words"))).otherwise(acc)

    return F.aggregate(lines, start, step, lambda acc: F.when(acc["words"] >= words, acc["n"]).cast("int"))


def _shared_ranks(documents: DataFrame, rule: LineRuns) -> DataFrame:
    """(doc_id, doc, at, line, words, ranks): of each line that is repeated, the ranks by its first 1, 2, 4 ... lines.

    ``at`` counts the lines with words, ``line`` all lines. Ranks beyond the first unique one are null.
    """
    text = F.coalesce("text", F.lit(""))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("doc"), text.alias("text"))
    lines = docs.select("doc_id", "doc", F.posexplode(lines_with_words(F.col("text"))).alias("at", "x"))
    lines = lines.select(
        "doc_id", "doc", F.col("at").cast("long").alias("at"), "x.line", F.xxhash64("x.content").alias("a"), line_words(F.col("x.content")).alias("words")
    )
    lines = stored(lines, "line-all")
    suffixes = lines.join(_ranked(lines, ["a"], "line-ranks"), "a").drop("a").distinct()
    # A run with min_words words is one of so many lines at most.
    rounds, found = rule.min_words.bit_length() - 1, None
    for k in range(rounds + 1):
        suffixes = stored(suffixes, "line-suffixes")
        part = suffixes.withColumn("k", F.lit(k))
        found = part if found is None else found.unionByName(part, allowMissingColumns=True)
        if k == rounds or suffixes.isEmpty():
            break
        ahead = W.partitionBy("doc_id", "doc").orderBy("at").rangeBetween(1 << k, 1 << k)
        pairs = suffixes.select("doc_id", "doc", "at", F.col("rank").alias("a"), F.max("rank").over(ahead).alias("b"))
        pairs = stored(pairs.where("b is not null"), "line-pairs")
        suffixes = pairs.join(_ranked(pairs, ["a", "b"], "line-ranks"), ["a", "b"]).drop("a", "b")
    ranks = F.array(*(F.max(F.when(F.col("k") == k, F.col("rank"))) for k in range(rounds + 1)))
    # Dealt by text, so that the windows that follow need no other exchange.
    by_text = found.repartition("doc_id", "doc").groupBy("doc_id", "doc", "at")
    return by_text.agg(F.max("line").alias("line"), F.max("words").alias("words"), ranks.alias("ranks"))


def _runs(documents: DataFrame, rule: LineRuns) -> DataFrame:
    """(doc_id, doc, line, lines, n, a, b): the shortest runs with ``min_words`` words from and up to each repeated line.

    ``n``, ``a`` and ``b`` name the run: its length and its ranks by its first and its last 2**k lines, of which
    there is no larger power within it.
    """
    near = W.partitionBy("doc_id", "doc").orderBy("at")
    own, reach = F.collect_list(F.struct("at", "line", "words", "ranks")), rule.min_words - 1
    both = _shared_ranks(documents, rule).select(
        "doc_id", "doc", own.over(near.rangeBetween(0, reach)).alias("ahead"), F.reverse(own.over(near.rangeBetween(-reach, 0))).alias("behind")
    )
    sized = both.select(
        "doc_id", "doc", "ahead", "behind", _shortest(F.col("ahead"), rule.min_words).alias("n_ahead"), _shortest(F.col("behind"), rule.min_words).alias("n_behind")
    )
    forward = F.slice("ahead", 1, F.coalesce("n_ahead", F.lit(0)))
    backward = F.reverse(F.slice("behind", 1, F.coalesce("n_behind", F.lit(0))))
    runs = sized.select("doc_id", "doc", F.explode(F.array_distinct(F.array(forward, backward))).alias("run")).where(F.size("run") > 0)
    n = F.size("run")
    k = F.floor(F.log2(n + 0.5)).cast("int")
    named = runs.select(
        "doc_id",
        "doc",
        F.col("run")[0]["line"].alias("line"),
        F.col("run")["line"].alias("lines"),
        n.alias("n"),
        F.get(F.col("run")[0]["ranks"], k).alias("a"),
        F.get(F.get("run", n - F.pow(F.lit(2), k).cast("int"))["ranks"], k).alias("b"),
    )
    return named.where("a is not null and b is not null")


def repeated_runs(documents: DataFrame, rule: LineRuns = LineRuns()) -> DataFrame:
    """(doc_id, doc, line, lines): later copies of repeated runs with ``min_words`` words, which cover all such copies.

    ``doc`` is a hash of the text, ``lines`` are the numbers of the run's lines; first is by doc_id (null last),
    text hash and line.
    """
    runs = stored(_runs(documents, rule), "line-runs")
    firsts = runs.groupBy("n", "a", "b").agg(F.min(_place()).alias("first"), F.max(_place()).alias("last")).where("first != last")
    firsts = stored(firsts.drop("last"), "line-firsts")
    return runs.join(firsts, ["n", "a", "b"]).where(_place() != F.col("first")).select("doc_id", "doc", "line", "lines")


def removed_lines(documents: DataFrame, rule: LineRuns = LineRuns()) -> DataFrame:
    """(doc_id, doc, removed): the numbers, from 0, of the lines that each text loses; texts without any are left out."""
    runs = repeated_runs(documents, rule).groupBy("doc_id", "doc").agg(F.collect_set("lines").alias("runs"))
    return runs.select("doc_id", "doc", F.array_sort(F.array_distinct(F.flatten("runs"))).alias("removed"))


def _removed(documents: DataFrame, rule: LineRuns) -> DataFrame:
    with working_tables(documents.sparkSession):
        return kept(removed_lines(documents, rule), "line-removed")


def line_report(documents: DataFrame, rule: LineRuns = LineRuns()) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed) of every row; ``removed`` lists line numbers, comma-joined.

    Null and empty texts have one empty line; lines without words are passed over: they neither end a run nor
    are deleted. Rows that repeat id and text keep the same lines. Other columns are left out; an empty table gives
    an empty result.
    """
    gone = _removed(documents, rule).withColumnRenamed("doc_id", "gone_id")
    text = F.coalesce("text", F.lit(""))
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("doc"), F.size(F.split(text, "\n")).cast("long").alias("n_lines")
    )
    joined = docs.join(gone, (docs["doc"] == gone["doc"]) & F.col("doc_id").eqNullSafe(F.col("gone_id")), "left")
    return joined.select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.transform("removed", lambda x: x.cast("string")), ","), F.lit("")).alias("removed"),
    )


def dedup_lines(documents: DataFrame, rule: LineRuns = LineRuns()) -> DataFrame:
    """``documents`` without the later copies of repeated runs, all columns kept.

    A text all of whose lines go becomes empty; what to do with its row is the caller's choice. Null texts stay.
    Rows that repeat id and text lose the same lines, an empty table gives an empty one. Only rows that a Bloom filter
    of the changed texts lets through are shuffled.
    """
    gone_id, gone_doc, removed = (fresh(documents, n) for n in ("gone_id", "gone_doc", "removed"))
    gone = _removed(documents, rule).toDF(gone_id, gone_doc, removed)
    likely, others = parted(documents, text_key(F.col("text")), gone.select(gone_doc))
    on = (text_key(F.col("text")) == F.col(gone_doc)) & F.col("doc_id").cast("long").eqNullSafe(F.col(gone_id))
    joined = likely.join(gone, on, "left")
    lines = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0).cast("long"), (F.size(lines) - 1).cast("long")), F.col(removed))
    cut = F.transform(F.array(lines), lambda x: F.array_join(F.transform(left, lambda i: F.get(x, i.cast("int"))), "\n"))[0]
    text = F.when(F.col(removed).isNull(), F.col("text")).otherwise(cut)
    return others.union(joined.withColumn("text", text).select(*documents.columns))
