"""URL filters: host and path rules, then a classifier over segmented host and path words.

Host labels such as ``freecasinobets`` are split into words by Viterbi over a unigram model, and multinomial
naive Bayes scores the words of host and path. Both models are counted over all rows and stay tables: whatever needs
a word's figures is joined with them, so that no vocabulary is cut off. Word frequencies come from hosts and from
running text, half of the weight each.

Pages have no labels. Seed words only start the class ``block``: hosts that show one are believed to be of it with a
chance, and so are paths with two; words are counted by these beliefs, the model's own scores replace them where they are
sure, and words are counted again (expectation maximisation), so that other words of such hosts and paths come to count,
and a seed among words of good hosts counts less. Where scores aren't sure, the first belief stays: words that every
other host has, such as ``blog`` and ``com``, would else carry one class over into the other. Beliefs are whole thousandths: their sums are the same on any layout. Hosts are
counted once each, and so is a path's set of words for each host, so that a host with most pages doesn't drown the others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.llm.joins import spread_join
from quotemill.llm.storage import kept, stored, working_tables

# Words of hosts that nobody wants in a corpus; the seeds of the class block.
SEEDS = (
    "adult", "bet", "bets", "betting", "casino", "escort", "jackpot", "payday", "phish", "pills",
    "poker", "porn", "sex", "slots", "spam", "viagra", "warez", "win", "xxx",
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (
    Rule("block", "com", "/en/"),
    Rule("allow", "example.com", "/en/7"),
    Rule("allow", "net", "/de/"),
    Rule("block", "example.net", "/de/8"),
    Rule("block", "org", "/es/"),
)


@dataclass(frozen=True)
class UrlModel:
    #: Letters of the longest word of the unigram model; longer pieces than ``max_piece`` (no host label is) are one word.
    max_word: int = 20
    max_piece: int = 63
    #: Occurrences that are added to each word's count in each class.
    smoothing: float = 0.1
    #: Chances of block that the first count believes in: where seeds are seen, and elsewhere, in thousandths.
    seen: int = 900
    unseen: int = 20
    #: Occurrences in block that a seed has before any are counted.
    seed_count: float = 1.0
    #: Log odds from which on a score, of either sign, replaces the first belief.
    sure: float = 2.0
    #: Times that words are counted and pages scored.
    rounds: int = 3
    #: A page is blocked if the log odds of block are above this.
    threshold: float = 0.0
    #: Parts that the rows of one key are dealt to where a table is joined to them.
    salts: int = 8


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def matched_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct (name, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


#: What separates words: anything but letters; digits carry no word.
_BETWEEN = r"[^a-z\x{80}-\x{10ffff}]+"


def pieces_of(part: Column) -> Column:
    return F.array_remove(F.split(F.lower(part), _BETWEEN), "")


def segment(word: str, log_p: dict[str, float], unknown: float, max_word: int) -> list[str]:
    """The likeliest split of ``word``: Viterbi over unigrams; an unknown piece costs ``unknown`` a letter and once more."""
    best, back = [0.0] + [-math.inf] * len(word), [0] * (len(word) + 1)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - max_word), end):
            piece = word[start:end]
            score = best[start] + log_p.get(piece, unknown * (len(piece) + 1))
            if score > best[end]:
                best[end], back[end] = score, start
    out, end = [], len(word)
    while end:
        out.append(word[back[end] : end])
        end = back[end]
    return out[::-1]


def _shares(counts: DataFrame) -> DataFrame:
    """(word, p) from (word, n): shares of all occurrences."""
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("word", (F.col("n") / F.col("total")).alias("p"))


def unigrams(hosts: DataFrame, texts: DataFrame | None, seeds: tuple[str, ...], model: UrlModel) -> DataFrame:
    """(word, p): the mean of a word's shares among words of distinct hosts and among words of ``texts``.

    A label without hyphens may be words run together: it counts as a host's word only if two hosts have it. The seeds are
    in the model even where no host shows them. A text's words count once for each text, and are whole texts' words.
    """
    fits = F.length("word").between(2, model.max_word)
    labels = hosts.select(F.explode(F.split("host", r"\.")).alias("label"))
    words = labels.select(pieces_of(F.col("label")).alias("w")).select((F.size("w") > 1).alias("parted"), F.explode("w").alias("word"))
    counts = words.where(fits).groupBy("word").agg(F.count("*").alias("n"), F.max("parted").alias("parted"))
    counts = counts.where("parted or n > 1").select("word", "n")
    known = hosts.sparkSession.createDataFrame([(w, 1) for w in seeds], "word string, n long")
    out = _shares(stored(counts.union(known).groupBy("word").agg(F.sum("n").alias("n")), "url-host-counts"))
    if texts is None:
        return out
    running = texts.select(F.explode(F.array_distinct(pieces_of(F.col("text")))).alias("word")).where(fits)
    running = stored(running.groupBy("word").agg(F.count("*").alias("n")), "url-text-counts")
    return out.union(_shares(running)).groupBy("word").agg((F.sum("p") / 2).alias("p"))


def segmented(pieces: DataFrame, counts: DataFrame, model: UrlModel) -> DataFrame:
    """(piece, words) of distinct pieces: each is split by Viterbi over those of its substrings that the model has.

    Substrings are rows that meet the counts in a join; what comes back to a piece is bounded by its length.
    """
    least = counts.agg(F.min("p").alias("least"))  # the rarest known word: an unknown letter costs more than it
    p = counts.select("word", F.log("p").alias("p"))
    short = pieces.where(F.length("piece") <= model.max_piece)
    ends = F.transform(F.sequence(F.lit(1), F.length("piece")), lambda at: F.transform(F.sequence(F.lit(1), F.least(F.length("piece") - at + 1, F.lit(model.max_word))), lambda n: F.substring(F.col("piece"), at, n)))
    parts = short.select("piece", F.explode(F.array_distinct(F.flatten(ends))).alias("word"))
    found = spread_join(parts, p, "word", model.salts).groupBy("piece").agg(F.map_from_entries(F.collect_list(F.struct("word", "p"))).alias("p"))
    known = pieces.join(found, "piece", "left").crossJoin(F.broadcast(least))

    @F.pandas_udf("array<string>")
    def split(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for words, figures, rarest in batches:
            yield pd.Series(
                [
                    segment(w, dict(f), math.log(least / 26.0), model.max_word) if f is not None else [w]
                    for w, f, least in zip(words, figures, rarest, strict=True)
                ]
            )

    return known.select("piece", split("piece", "p", "least").alias("words"))


def word_odds(words: DataFrame, seeds: tuple[str, ...], model: UrlModel) -> DataFrame:
    """(word, odds) from (word, belief): log of the smoothed share among blocked words over that among allowed ones.

    A row is ``belief`` thousandths of a blocked word, and the rest of an allowed one. The shares are smoothed by the distinct
    words that were counted; seeds have occurrences in block beforehand.
    """
    counts = words.groupBy("word").agg(F.sum("belief").alias("b"), (F.count("*") * 1000 - F.sum("belief")).alias("a"))
    given = F.when(F.substring("word", 3, model.max_word).isin(*seeds), F.lit(int(model.seed_count * 1000))).otherwise(0)
    counts = stored(counts.withColumn("b", F.col("b") + given), "url-counts")
    total = counts.agg(F.sum("b").alias("b_all"), F.sum("a").alias("a_all"), F.count("*").alias("size"))
    share = lambda k, of: (F.col(k) / 1000 + model.smoothing) / (F.col(of) / 1000 + model.smoothing * F.col("size"))
    odds = F.log(share("b", "b_all")) - F.log(share("a", "a_all"))
    return counts.crossJoin(F.broadcast(total)).select("word", odds.alias("odds"))


def _scored(pairs: DataFrame, texts: DataFrame | None, seeds: tuple[str, ...], model: UrlModel) -> DataFrame:
    """(pair, score, words) of (pair, host, path_words): the log odds of block."""
    hosts = stored(pairs.select("host").distinct(), "url-hosts")
    placed = hosts.select("host", F.posexplode(pieces_of(F.col("host"))).alias("place", "piece"))
    pieces = stored(placed.select("piece").distinct(), "url-pieces")
    split = stored(segmented(pieces, stored(unigrams(hosts, texts, seeds, model), "url-unigrams"), model), "url-split")
    of_host = spread_join(placed, split, "piece", model.salts).select("host", "place", F.posexplode("words").alias("within", "w"))
    of_host = stored(of_host.withColumn("word", F.concat(F.lit("h:"), "w")), "url-host-words")
    of_path = pairs.select("pair", F.posexplode("path_words").alias("place", "w")).withColumn("word", F.concat(F.lit("p:"), "w"))

    first = lambda is_seen: F.when(is_seen, model.seen).otherwise(model.unseen).cast("long")
    shown = of_host.where(F.col("w").isin(*seeds)).select("host").distinct().withColumn("shown", F.lit(True))
    at_first = stored(hosts.join(shown, "host", "left").select("host", first(F.col("shown")).alias("first")), "url-host-beliefs")
    by_host = at_first.select("host", F.col("first").alias("belief"))
    twice = F.size(F.array_intersect("path_words", F.array(*[F.lit(w) for w in seeds]))) > 1
    pairs = spread_join(pairs, at_first.withColumnRenamed("first", "of_host"), "host", model.salts)
    pairs = stored(pairs.select("pair", "host", F.greatest("of_host", first(twice)).alias("first")), "url-pair-beliefs")
    by_pair = pairs.select("pair", F.col("first").alias("belief"))

    def summed(words: DataFrame, odds: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
        listed = F.array_sort(F.collect_list(F.struct(*order, "word")))["word"]
        return spread_join(words, odds, "word", model.salts).groupBy(key).agg(F.sum("odds").alias(name), listed.alias(f"{name}_words"))

    def believed(score: Column) -> Column:
        sure = F.abs(score) >= model.sure
        return F.when(sure, F.round(1000 / (1 + F.exp(-score))).cast("long")).otherwise(F.col("first")).alias("belief")

    none = F.array().cast("array<string>")
    for _ in range(model.rounds):
        counted = [words.join(beliefs, key).select("word", "belief") for words, beliefs, key in ((of_host, by_host, "host"), (of_path, by_pair, "pair"))]
        odds = stored(word_odds(counted[0].union(counted[1]), seeds, model), "url-odds")
        thousandths = by_host.agg(F.sum("belief").alias("b"), (F.count("*") * 1000).alias("n"))
        prior = F.log((F.col("b") / 1000 + model.smoothing) / ((F.col("n") - F.col("b")) / 1000 + model.smoothing))
        scores = at_first.join(summed(of_host, odds, "host", ["place", "within"], "host_odds"), "host", "left")
        scores = scores.crossJoin(F.broadcast(thousandths.select(prior.alias("prior"))))
        scores = scores.withColumn("host_score", F.round(F.col("prior") + F.coalesce("host_odds", F.lit(0.0)), 9))
        by_host = stored(scores.select("host", "host_score", "host_odds_words", believed(F.col("host_score"))), "url-host-beliefs")
        both = spread_join(pairs, by_host.drop("belief"), "host", model.salts)
        both = both.join(summed(of_path, odds, "pair", ["place"], "path_odds"), "pair", "left")
        score = F.round(F.col("host_score") + F.coalesce("path_odds", F.lit(0.0)), 9)
        words = F.concat_ws(" ", F.coalesce("host_odds_words", none), F.coalesce("path_odds_words", none))
        by_pair = stored(both.select("pair", score.alias("score"), words.alias("words"), believed(score)), "url-pair-beliefs")
        by_host = by_host.select("host", "belief")
    return by_pair.select("pair", "score", "words")


def judge_urls(
    pages: DataFrame, texts: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, model: UrlModel = UrlModel(), seeds: tuple[str, ...] = SEEDS
) -> DataFrame:
    """Verdict of every page: page_id, host, path, rule, verdict, score (log odds of block), words.

    ``texts`` (column text; null texts have no words) gives word frequencies besides the hosts' own.

    A null url or one without ``://`` has an empty host and path, no words, and the prior as its score; a table
    without seeds in hosts or paths blocks nothing but by rules. Repeated rows and ties are judged alike, a null page_id is kept, very long
    urls are read whole, other columns are left out, an empty table gives an empty result.
    """
    path_words = F.array_distinct(pieces_of(F.col("path")))
    urls = pages.select("page_id", F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"), F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"))
    urls = urls.withColumn("path_words", path_words).withColumn("pair", F.xxhash64("host", "path_words"))
    with working_tables(pages.sparkSession):
        pairs = urls.groupBy("pair").agg(F.min("host").alias("host"), F.min("path_words").alias("path_words"))
        scores = kept(_scored(stored(pairs, "url-pairs"), texts, seeds, model), "url-scores")
    judged = spread_join(urls.drop("path_words"), scores, "pair", model.salts).withColumn("fit", matched_rule(F.col("host"), F.col("path"), rules))
    by_model = F.when(F.col("score") > model.threshold, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id", "host", "path", F.col("fit.name").alias("rule"), F.coalesce(F.col("fit.verdict"), by_model).alias("verdict"), "score", "words"
    )
