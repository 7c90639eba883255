"""Substring dedup by sliding sentence spans.

Of every sentence of a text, the shortest runs of ``least_sentences`` sentences or more with ``span_words`` words from
it on and up to it are hashed. Hashes are joined over all texts; every occurrence of a span but the first covers
sentences to remove.

These spans cover every repeated run of so many sentences and words, however long: each sentence of it is in
the shortest span that ends at that sentence, or in the one that starts where the run starts. Both lie within the
run and are repeated with it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.storage import fresh, kept, stored, working_tables
from quotemill.llm.tokens import as_bytes


@dataclass(frozen=True)
class SentenceSpans:
    #: A span is a shortest run of consecutive sentences with so many words,
    span_words: int = 24
    #: and of so many sentences.
    least_sentences: int = 2


#: Within a line, a sentence ends behind . ! or ? and white space.
_ENDS = re.compile(rb"(?<=[.!?])[ \t]+")


def sentences_of(text: bytes) -> tuple[list[tuple[int, int]], list[bytes]]:
    """Byte spans of the sentences of ``text``, and each as its words in lower case; no sentence goes over a line's end."""
    spans, parts, at = [], [], 0
    for line in text.split(b"\n"):
        ends = [*(m.span() for m in _ENDS.finditer(line)), (len(line), len(line))]
        start = 0
        for end, following in ends:
            words = line[start:end].split()
            if words:
                own = line[start:end]
                first = at + start + len(own) - len(own.lstrip())
                spans.append((first, first + len(own.strip())))
                parts.append(b" ".join(words).lower())
            start = following
        at += len(line) + 1
    return spans, parts


def span_runs(words: list[int], rule: SentenceSpans) -> list[tuple[int, int]]:
    """(first, behind last) sentence of each span: the shortest from each sentence on, and the shortest up to each."""
    n = len(words)
    return sorted({*_slid(words, rule), *((n - b, n - a) for a, b in _slid(words[::-1], rule))})


def _slid(words: list[int], rule: SentenceSpans) -> list[tuple[int, int]]:
    """The shortest spans from each sentence on: a window that slides on by one sentence."""
    out, end, total = [], 0, 0
    for start in range(len(words)):
        while end < len(words) and (total < rule.span_words or end - start < rule.least_sentences):
            total += words[end]
            end += 1
        if total < rule.span_words or end - start < rule.least_sentences:
            break
        out.append((start, end))
        total -= words[start]
    return out


def _spans(documents: DataFrame, rule: SentenceSpans) -> DataFrame:
    """(span, doc_id, doc, first, last, words_before..): one row for each span of each text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            cols: dict[str, list] = {"span": [], "doc_id": [], "doc": [], "first": [], "behind": []}
            for doc_id, text in zip(ids, as_bytes(batch["text"]), strict=True):
                if not text:
                    continue
                _, parts = sentences_of(text)
                doc = np.uint64(xxhash.xxh3_64_intdigest(text)).view(np.int64)
                for a, b in span_runs([p.count(b" ") + 1 for p in parts], rule):
                    h = xxhash.xxh3_64_intdigest(b"\n".join(parts[a:b]))
                    cols["span"].append(h - (1 << 64) if h >> 63 else h)
                    cols["doc_id"].append(doc_id)
                    cols["doc"].append(int(doc))
                    cols["first"].append(a)
                    cols["behind"].append(b)
                if len(cols["span"]) > 50_000:
                    yield _batch(cols)
                    cols = {k: [] for k in cols}
            yield _batch(cols)

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(rows, "span long, doc_id long, doc long, first int, behind int")


def _batch(cols: dict[str, list]) -> pa.RecordBatch:
    kinds = {"first": pa.int32(), "behind": pa.int32()}
    return pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in cols.items()})


def later_spans(documents: DataFrame, rule: SentenceSpans = SentenceSpans()) -> DataFrame:
    """(doc_id, doc, first, behind, kept_doc_id): every span that is not the first of its kind.

    First is by doc_id (null last), text hash and place. The earliest occurrence of each repeated span comes
    from a grouped minimum, combined on the map side; no group of equal spans is gathered. Null and empty texts have
    no spans, rows that repeat id and text have the same ones; an empty table gives an empty result.
    """
    spans = stored(_spans(documents, rule), "spans")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc", "first")
    firsts = spans.groupBy("span").agg(F.min(place).alias("kept"), F.count("*").alias("n")).where("n > 1")
    firsts = stored(firsts.select("span", "kept"), "span-firsts")
    later = spans.join(firsts, "span").where(~place.eqNullSafe(F.col("kept")))
    return later.select("doc_id", "doc", "first", "behind", F.col("kept.doc_id").alias("kept_doc_id"))


def removed_sentences(documents: DataFrame, rule: SentenceSpans = SentenceSpans()) -> DataFrame:
    """(doc_id, doc, removed, kept_ids) of every text that loses sentences.

    ``removed``: the numbers of its sentences, from 0, that a non-first span covers; ``kept_ids``: the documents
    that keep them. A text's own spans are at most twice as many as its sentences, which bounds a row. Nulls, repeated
    rows and empty tables as in ``later_spans``.
    """
    with working_tables(documents.sparkSession):
        spans = later_spans(documents, rule).groupBy("doc_id", "doc").agg(
            F.collect_set(F.struct("first", "behind")).alias("covers"), F.collect_set("kept_doc_id").alias("kept_ids")
        )
        numbers = F.flatten(F.transform("covers", lambda c: F.sequence(c["first"], c["behind"] - 1)))
        removed = spans.select(
            "doc_id", "doc", F.array_sort(F.array_distinct(numbers)).alias("removed"), F.array_sort("kept_ids").alias("kept_ids")
        )
        return kept(removed, "span-removed")


def remove_repeated_spans(documents: DataFrame, rule: SentenceSpans = SentenceSpans()) -> DataFrame:
    """``documents`` with the text's covered sentences cut out, and all their columns.

    Null and empty texts, and texts without a repeated span, stay as they are; of rows that repeat id and text
    all keep the same sentences; an empty table gives an empty result.
    """
    gone_id, gone_doc, removed, own = (fresh(documents, n) for n in ("gone_id", "gone_doc", "removed", "own_doc"))
    gone = removed_sentences(documents, rule).select("doc_id", "doc", "removed").toDF(gone_id, gone_doc, removed)

    @F.pandas_udf("long")
    def named(texts):
        return texts.map(lambda t: None if t is None else int(np.uint64(xxhash.xxh3_64_intdigest(t.encode())).view(np.int64)))

    @F.pandas_udf("string")
    def cut(texts, gaps):
        out = []
        for text, numbers in zip(texts, gaps, strict=True):
            if text is None or numbers is None or not len(numbers):
                out.append(text)
                continue
            raw, drop = text.encode(), set(numbers)
            spans, _ = sentences_of(raw)
            kept, at = [], 0
            for k, (a, b) in enumerate(spans):
                if k in drop:
                    kept.append(raw[at:a])
                    at = b
            out.append(b"".join([*kept, raw[at:]]).decode())
        return pd.Series(out)

    marked = documents.withColumn(own, named("text"))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col(gone_id)) & (F.col(own) == F.col(gone_doc))
    joined = marked.join(gone, on, "left").withColumn("text", cut("text", removed))
    return joined.select(*documents.columns)
