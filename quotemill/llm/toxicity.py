"""Toxicity by classifier chains.

Linear models over hashed words and word beginnings predict one category after the other; each later model also
gets the probabilities of the earlier categories. The label is the last category; those before it are kinds of toxic
texts, which are found in the labelled rows: groups of rows that share the features which toxic rows have oftener. While fitting, those come from models that did not see the row
(out-of-fold), so that the chain learns from probabilities as good as those it meets later.
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
from quotemill.llm.tokens import ALNUM, Words, as_bytes, groups_of, mixed

#: The kinds of toxic texts that fitting finds, and last the label itself.
CATEGORIES = ("kind_1", "kind_2", "toxic")


@dataclass(frozen=True)
class ChainModel:
    buckets: int = 1 << 17
    #: Bytes of the word beginnings that are features beside the words.
    beginnings: tuple[int, ...] = (4, 5, 6, 7)
    #: Most labelled rows that the chain is fitted on; rows in which a feature must occur.
    most_rows: int = 5000
    min_rows: int = 6
    #: How far, in standard deviations, a feature must be more frequent in rows of the category than in all.
    min_z: float = 4.0
    folds: int = 4
    epochs: int = 12
    rate: float = 0.3
    decay: float = 1e-3
    threshold: float = 0.4
    seed: int = 5


def features_of(words: Words, model: ChainModel) -> np.ndarray:
    """Distinct (text << 32 | bucket) of a group: its words and their beginnings."""
    doc = words.doc_of_word()
    keys, lens = [words.hashes], words.ends - words.starts
    docs = [doc]
    for n in model.beginnings:
        at = np.flatnonzero(lens > n)
        letters = words.buf[words.starts[at][:, None] + np.arange(n)].astype(np.uint64)
        packed = (letters << (np.arange(n, dtype=np.uint64) * np.uint64(8))).sum(axis=1, dtype=np.uint64) if len(at) else np.zeros(0, np.uint64)
        keys.append(mixed(packed + np.uint64((n * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)))
        docs.append(doc[at])
    bucket = np.concatenate(keys) & np.uint64(model.buckets - 1)
    return np.unique((np.concatenate(docs).astype(np.uint64) << np.uint64(32)) | bucket)


def by_text(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets in the order of the texts, and the bounds of each of the ``n`` texts."""
    doc = (keys >> np.uint64(32)).astype(np.int64)
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.int32), np.searchsorted(doc, np.arange(n + 1))


def _sample(rows: DataFrame, model: ChainModel) -> pd.DataFrame:
    """(doc_id, label, feats) of the labelled rows, one for each id: that with the smallest text hash."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            feats = []
            for words in groups_of(as_bytes(batch["text"]), ALNUM):
                buckets, bounds = by_text(features_of(words, model), len(words))
                feats += [buckets[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "label": batch["label"], "feats": pa.array(feats, pa.list_(pa.int32()))})

    return rows.mapInArrow(found, "doc_id long, label int, feats array<int>").toPandas()


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def selected(rows: list[np.ndarray], y: np.ndarray, model: ChainModel) -> list[np.ndarray]:
    """``rows`` with only the features that occur in enough rows, and clearly oftener in those of the category."""
    flat, hit = np.concatenate([*rows, np.zeros(0, np.int64)]), np.repeat(y, [len(r) for r in rows])
    n = np.bincount(flat, minlength=model.buckets)
    expected = n * (y.mean() if len(y) else 0.0)
    z = (np.bincount(flat, hit, model.buckets) - expected) / np.sqrt(np.maximum(expected, 1e-9))
    keep = (n >= model.min_rows) & (z >= model.min_z)
    return [r[keep[r]] for r in rows]


def kinds_of(rows: list[np.ndarray], y: np.ndarray, model: ChainModel) -> list[np.ndarray]:
    """Of each row whether it is of each kind: two groups of the toxic rows by the selected features that they share.

    The groups start from the rows with the commonest feature, and from those with the commonest one of the rest; each
    row then goes to the group in which a mean row has most of its features, until none moves. Ties go to the first.
    """
    toxic = np.flatnonzero(y > 0)
    own = selected(rows, y, model)
    names, at = np.unique(np.concatenate([*(own[k] for k in toxic), np.zeros(0, np.int64)]), return_inverse=True)
    has = np.zeros((len(toxic), len(names)))
    has[np.repeat(np.arange(len(toxic)), [len(own[k]) for k in toxic]), at] = 1.0
    second = np.zeros(len(toxic), dtype=bool)
    if len(names):
        first = has[:, has.sum(axis=0).argmax()] > 0
        second = ~first & (has[:, (has[~first]).sum(axis=0).argmax()] > 0)
        for _ in range(model.epochs):
            means = [has[g].sum(axis=0) / np.sqrt(max(1, g.sum())) for g in (~second, second)]
            moved = has @ (means[1] - means[0]) > 0
            if (moved == second).all():
                break
            second = moved
    out = [np.zeros(len(rows)), np.zeros(len(rows))]
    out[0][toxic[~second]], out[1][toxic[second]] = 1.0, 1.0
    return out


def fit_linear(rows: list[np.ndarray], extra: np.ndarray, y: np.ndarray, model: ChainModel) -> tuple[np.ndarray, np.ndarray]:
    """Logistic weights of the buckets, and of ``extra`` (earlier probabilities) with the intercept last."""
    rows = selected(rows, y, model)
    rng = np.random.default_rng(model.seed)
    w, v = np.zeros(model.buckets), np.zeros(extra.shape[1] + 1)
    sums, sums_v = np.full(model.buckets, 1e-2), np.full(len(v), 1e-2)
    dense = np.hstack([extra, np.ones((len(y), 1))])
    batch = 32
    for _ in range(model.epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            lens = [len(rows[k]) for k in own]
            cols = np.concatenate([rows[k] for k in own])
            line = np.repeat(np.arange(len(own)), lens)
            p = sigmoid(np.bincount(line, w[cols], len(own)) + dense[own] @ v)
            g = (p - y[own]) / len(own)
            used, where = np.unique(cols, return_inverse=True)
            grad = np.bincount(where, g[line], len(used)) + model.decay * w[used]
            sums[used] += grad**2
            w[used] -= model.rate * grad / np.sqrt(sums[used])
            grad_v = g @ dense[own]
            sums_v += grad_v**2
            v -= model.rate * grad_v / np.sqrt(sums_v)
    return w, v


def fit_chain(sample: pd.DataFrame, model: ChainModel) -> list[tuple[np.ndarray, np.ndarray]]:
    """A linear model for each category, in order."""
    rows = [np.asarray(f, dtype=np.int64) for f in sample["feats"]]
    toxic = sample["label"].to_numpy(dtype=float)
    targets = [*kinds_of(rows, toxic, model), toxic]
    fold = np.arange(len(rows)) % model.folds
    extra, chain = np.zeros((len(rows), 0)), []
    for y in targets:
        chain.append(fit_linear(rows, extra, y, model))
        unseen = np.zeros(len(rows))
        for f in range(model.folds):
            fit, out = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            w, v = fit_linear([rows[k] for k in fit], extra[fit], y[fit], model)
            z = np.array([w[rows[k]].sum() for k in out]) + extra[out] @ v[:-1] + v[-1]
            unseen[out] = sigmoid(z)
        extra = np.hstack([extra, unseen[:, None]])
    return chain


def score_toxicity(documents: DataFrame, labels: DataFrame, model: ChainModel = ChainModel()) -> DataFrame:
    """(doc_id, held_out, p_kind_1, p_kind_2, score, toxic) of every row.

    ``score`` is the probability of the last category, ``toxic`` is 1 where it reaches the threshold. Null and
    empty texts get the scores of a text without words; equal texts get equal scores; without labelled rows all
    probabilities are 0.5; null ids are kept; other columns are left out; an empty table gives an empty result. Whole texts are
    scored by models of fixed size; labels are used only for fitting, from rows that are not held out.
    """
    sample = _sample(training_rows(documents, labels, "toxic", model.most_rows), model)
    sample = sample.assign(k=mixed(sample["doc_id"].to_numpy().astype(np.uint64))).sort_values(["k", "doc_id"], kind="stable")
    shared = documents.sparkSession.sparkContext.broadcast([(w.astype(np.float32), v) for w, v in fit_chain(sample, model)])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for batch in batches:
            out = [[] for _ in CATEGORIES]
            for words in groups_of(as_bytes(batch["text"]), ALNUM):
                n = len(words)
                buckets, bounds = by_text(features_of(words, model), n)
                line = np.repeat(np.arange(n), np.diff(bounds))
                extra = np.zeros((n, 0))
                for k, (w, v) in enumerate(chain):
                    p = sigmoid(np.bincount(line, w[buckets], n) + extra @ v[:-1] + v[-1])
                    out[k].append(p)
                    extra = np.hstack([extra, p[:, None]])
            columns = {f"p_{c}": pa.array(np.round(np.concatenate(p or [np.zeros(0)]), 9)) for c, p in zip(CATEGORIES, out, strict=True)}
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], **columns})

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, " + ", ".join(f"p_{c} double" for c in CATEGORIES)
    out = docs.mapInArrow(scored, schema)
    return out.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        *[f"p_{c}" for c in CATEGORIES[:-1]],
        F.col("p_toxic").alias("score"),
        F.when(F.col("p_toxic") >= model.threshold, 1).otherwise(0).alias("toxic"),
    )
