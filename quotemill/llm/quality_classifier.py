"""Quality classifier by supervised subword embeddings.

Vectors of hashed words, repeated words and character 3-grams are averaged over a document; a softmax layer over the average
gives the class. Vectors and layer are learned together by stochastic gradient descent in numpy, from a bounded
sample of the labelled documents. Both are linear, so a document's log odds are the mean of one number for each
n-gram, which is what the scoring tasks get.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.labelled import held_out, training_rows
from quotemill.llm.tokens import Words, as_bytes, groups_of, mixed


@dataclass(frozen=True)
class SubwordModel:
    buckets: int = 1 << 16
    dimensions: int = 12
    epochs: int = 8
    rate: float = 0.5
    #: Most labelled documents that the model is fitted on.
    most_rows: int = 3000
    threshold: float = 0.3
    seed: int = 11


def grams_of(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all 3-grams and words of a group; a word that repeats the one before it is a mark of its own."""
    half = np.uint64(buckets // 2 - 1)
    b = words.buf.astype(np.uint64)
    if len(b) >= 3:
        grams = b[:-2] | (b[1:-1] << np.uint64(8)) | (b[2:] << np.uint64(16))
        grams = ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) & half
    else:
        grams = np.zeros(0, np.uint64)
    tokens = ((words.hashes & half) + half + np.uint64(1)).astype(np.int32)
    again = np.flatnonzero(words.hashes[1:] == words.hashes[:-1]) + 1
    tokens[np.setdiff1d(again, words.bounds)] = buckets // 2
    return grams.astype(np.int32), tokens


def _ranges(words: Words) -> Iterator[tuple[slice, slice]]:
    """3-grams and words of each text; a 3-gram doesn't reach into the next text."""
    for k in range(len(words)):
        start, end = int(words.text_starts[k]), int(words.text_starts[k + 1]) - 1
        yield slice(start, end - 2) if end - start > 2 else slice(0, 0), slice(int(words.bounds[k]), int(words.bounds[k + 1]))


def _training_grams(rows: DataFrame, model: SubwordModel) -> pd.DataFrame:
    """(doc_id, label, grams, counts), one row for each labelled document of the sample."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, counts = [], []
            for words in groups_of(as_bytes(batch["text"]), lower=False):
                chars, tokens = grams_of(words, model.buckets)
                for c, w in _ranges(words):
                    g, n = np.unique(np.concatenate((chars[c], tokens[w])), return_counts=True)
                    grams.append(g)
                    counts.append(n.astype(np.int32))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "label": batch["label"],
                    "grams": pa.array(grams, pa.list_(pa.int32())),
                    "counts": pa.array(counts, pa.list_(pa.int32())),
                }
            )

    return rows.mapInArrow(features, "doc_id long, label int, grams array<int>, counts array<int>").toPandas()


def fit(sample: pd.DataFrame, model: SubwordModel) -> tuple[np.ndarray, float]:
    """One log-odds number for each bucket, and those of a text without n-grams."""
    rng = np.random.default_rng(model.seed)
    vectors = rng.uniform(-0.5, 0.5, (model.buckets, model.dimensions)).astype(np.float32) / model.dimensions
    layer = np.zeros((model.dimensions, 2), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    rows = [
        (np.asarray(g), np.asarray(c, dtype=np.float32) / max(1, int(np.sum(c))), int(y))
        for g, c, y in zip(sample["grams"], sample["counts"], sample["label"], strict=True)
        if len(g)
    ]
    steps, step = max(1, len(rows) * model.epochs), 0
    for _ in range(model.epochs):
        for k in rng.permutation(len(rows)):
            grams, share, y = rows[k]
            rate = model.rate * (1 - step / steps)
            step += 1
            mean = share @ vectors[grams]
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = layer @ p
            layer -= rate * np.outer(mean, p)
            bias -= 0.1 * rate * p
            # Shares are small where a text has many n-grams: the step is that of an n-gram, not of a text.
            vectors[grams] -= (rate * np.minimum(1.0, share * len(grams)))[:, None] * (back / np.sqrt(len(grams)))
    direction = layer[:, 1] - layer[:, 0]
    return (vectors @ direction).astype(np.float32), float(bias[1] - bias[0])


def score_quality(documents: DataFrame, labels: DataFrame, model: SubwordModel = SubwordModel()) -> DataFrame:
    """``documents`` with columns ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (0 or 1).

    Only texts are inputs of a score. Null and empty texts get the score of a text without n-grams; equal texts
    get equal scores; without labelled rows every score is 0.5; columns of these names are replaced; an empty
    table gives an empty result. Whole texts are scored, by a model whose size is fixed.
    """
    sample = _training_grams(training_rows(documents, labels, "quality", model.most_rows), model)
    sample = sample.assign(k=mixed(sample["doc_id"].to_numpy().astype(np.uint64))).sort_values(["k", "doc_id"], kind="stable")
    odds, bias = fit(sample, model)
    shared = documents.sparkSession.sparkContext.broadcast((odds, bias))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        per_gram, rest = shared.value
        for texts in batches:
            out = np.empty(len(texts))
            # A few hundred texts at a time are encoded, so that a batch is not held twice.
            for first in range(0, len(texts), 256):
                raw = [None if t is None else t.encode() for t in texts.iloc[first : first + 256]]
                for words in groups_of(raw, lower=False):
                    chars, tokens = grams_of(words, model.buckets)
                    by_char = np.concatenate(([0.0], np.cumsum(per_gram[chars], dtype=np.float64)))
                    by_word = np.concatenate(([0.0], np.cumsum(per_gram[tokens], dtype=np.float64)))
                    for k, (c, w) in enumerate(_ranges(words)):
                        n = (c.stop - c.start) + (w.stop - w.start)
                        total = by_char[c.stop] - by_char[c.start] + by_word[w.stop] - by_word[w.start]
                        out[first + words.first_row + k] = (total / n if n else 0.0) + rest
            yield pd.Series(np.round(1.0 / (1.0 + np.exp(-out)), 9))

    scored = documents.withColumn("score", score("text"))
    return scored.withColumn("predicted", F.when(F.col("score") >= model.threshold, 1).otherwise(0))


def quality_report(documents: DataFrame, labels: DataFrame, model: SubwordModel = SubwordModel()) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    scored = score_quality(documents.select("doc_id", "text"), labels, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
