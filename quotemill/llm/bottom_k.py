"""Near-duplicate classes from bottom-k sketches made with one hash function.

1. A text's set of word shingles is hashed once; its sketch is its ``retained`` smallest values, or all of them.
   Equal sets are one node.
2. Inverted lists: a retained value has a list of the nodes that retain it. Two similar sets share most of the values
   retained of their union, so a node stands only in the lists of its rarest ones (``listed_values``), which no
   similar pair escapes but with a chance of ``risk``.
3. Overlaps: a list's pivot is compared with its nodes, and the links found make classes. Then only nodes of different
   classes that meet in a list are left: pairs from short lists; from long ones pairs of blocks, each compared in one task.
4. The sketch of the union (its ``retained`` smallest values) estimates the similarity and filters. A pair of sets that
   are wholly retained is decided by it; all others are confirmed on whole sets, read again from the texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quotemill.llm import ngram_join as whole
from quotemill.llm.components import connected_components
from quotemill.llm.folded import bloom_of, folded, parted
from quotemill.llm.joins import spread_join
from quotemill.llm.storage import kept, stored, working_tables
from quotemill.llm.tokens import as_bytes, groups_of, mixed


@dataclass(frozen=True)
class BottomK:
    shingle_words: int = 4
    percent: int = 80
    #: Values that a sketch retains.
    retained: int = 256
    #: Chance that the union of a similar pair retains fewer shared values than the filters ask for.
    risk: float = 1e-12
    #: Counters of the order by rarity.
    counters: int = 1 << 20
    #: 64-bit words of a sketch's bit map.
    map_words: int = 8
    #: Nodes of a list whose pairs are rows; longer ones are compared by blocks of so many nodes on average.
    short_list: int = 64
    block_nodes: int = 512
    #: Pivots that a node is compared with in the first turn.
    pivots: int = 2
    #: Texts of which a task remembers the node, to send equal texts once.
    remembered: int = 200_000
    #: Parts that the rows of one list, pivot or class are dealt to.
    salts: int = 8

    @property
    def sets(self) -> whole.JaccardJoin:
        return whole.JaccardJoin(shingle_words=self.shingle_words, percent=self.percent, remembered=self.remembered)


def least_shared(join: BottomK) -> int:
    """The most that a binomial count of ``retained`` values at the threshold is below with a chance of ``risk`` at most."""
    k, p, total = join.retained, join.percent / 100, 0.0
    for i in range(k + 1):
        total += math.exp(math.lgamma(k + 1) - math.lgamma(i + 1) - math.lgamma(k - i + 1) + i * math.log(p) + (k - i) * math.log1p(-p))
        if total > join.risk:
            return i
    return k


def _asked(n: int, join: BottomK, shared: int) -> int:
    """Values that the sketch of a set of ``n`` shares with that of any similar set."""
    return min(shared, -(-join.percent * n // 100))


def sketch_of(shingles: np.ndarray, join: BottomK) -> np.ndarray:
    """The smallest values of the set under the hash function, in order."""
    values = mixed(shingles)
    if len(values) > join.retained:
        values = np.partition(values, join.retained - 1)[: join.retained]
    return np.sort(values)


def listed_values(sketch: np.ndarray, n: int, counts: np.ndarray, join: BottomK, shared: int) -> np.ndarray:
    """The rarest values of a sketch: so many that ``_asked`` shared ones can't all be among the others."""
    seen = counts[(sketch & np.uint64(join.counters - 1)).astype(np.int64)]
    return sketch[np.lexsort((sketch, seen))[: len(sketch) - _asked(n, join, shared) + 1]]


def _counts(documents: DataFrame, join: BottomK) -> np.ndarray:
    def cells(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for words in groups_of(as_bytes(batch["text"])):
            found = [sketch_of(s, join) for s in whole.shingle_sets(words, join.shingle_words)]
            if found:
                yield (np.concatenate(found) & np.uint64(join.counters - 1)).astype(np.int64)

    return folded(documents.select("text"), join.counters, cells)


def _profiles(documents: DataFrame, join: BottomK) -> DataFrame:
    """(doc_id, n_shingles, node, listed); the last once for a node and task."""
    counts = documents.sparkSession.sparkContext.broadcast(_counts(documents, join))
    shared = least_shared(join)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            n, nodes, listed = [], [], []
            for words in groups_of(as_bytes(batch["text"])):
                for s in whole.shingle_sets(words, join.shingle_words):
                    n.append(len(s))
                    nodes.append(whole.node_of(s) if len(s) else None)
                    new = len(s) and nodes[-1] not in seen
                    if new:
                        if len(seen) >= join.remembered:
                            seen.clear()
                        seen.add(nodes[-1])
                    listed.append(listed_values(sketch_of(s, join), len(s), counts.value, join, shared).view(np.int64) if new else None)
            columns = {"doc_id": batch["doc_id"], "n_shingles": pa.array(n, pa.int64()), "node": pa.array(nodes, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns | {"listed": pa.array(listed, pa.list_(pa.int64()))})

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(profile, "doc_id long, n_shingles long, node long, listed array<long>")


def _lists(profiles: DataFrame) -> DataFrame:
    """(value, node) of the values that two nodes or more are listed under.

    Values are counted first, by 40 of their bits and without their nodes; most are alone, and only the others' rows
    are dealt with their nodes. A key with most rows is left to Spark, which splits the large side of a skewed join.
    """
    rows = profiles.where("listed is not null").select(F.explode("listed").alias("value"), "node")
    short = F.shiftright("value", 24)
    several = rows.groupBy(short.alias("short")).agg(F.count("*").alias("n")).where("n > 1").select("short")
    several = stored(several, "bottom-values")
    likely, _ = parted(rows.withColumn("short", short), F.col("short"), several)
    return stored(likely.join(several, "short").select("value", "node").distinct(), "bottom-lists")


def _nodes(documents: DataFrame, lists: DataFrame, join: BottomK) -> DataFrame:
    """(node, n, sketch, bits) of the nodes in ``lists``, read again from the texts."""
    shared = documents.sparkSession.sparkContext.broadcast(bloom_of(lists.select("node").distinct()))

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            rows = []
            for words in groups_of(as_bytes(batch["text"])):
                sets = [s for s in whole.shingle_sets(words, join.shingle_words) if len(s)]
                names = np.array([whole.node_of(s) for s in sets], dtype=np.int64)
                for k in np.flatnonzero(shared.value.may_hold(names.view(np.uint64))):
                    if int(names[k]) not in seen:
                        if len(seen) >= join.remembered:
                            seen.clear()
                        seen.add(int(names[k]))
                        sketch = sketch_of(sets[k], join)
                        rows.append((int(names[k]), len(sets[k]), sketch.tobytes(), whole.bit_map(sketch, join.map_words)))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, c, k in zip(("node", "n", "sketch", "bits"), zip(*rows, strict=True), kinds, strict=True)})

    found = documents.select("text").mapInArrow(sketches, "node long, n long, sketch binary, bits array<long>")
    return stored(found.dropDuplicates(["node"]), "bottom-nodes")


def _may_be_similar(join: BottomK) -> Column:
    """False only for pairs that can't be: sizes too far apart, or more bits that one sketch has alone than values may be.

    Of sets that are wholly retained the values of one alone are known; of others a sketch has as many as it
    retains, less what is shared.
    """
    sizes = 100 * F.least("na", "nb") >= join.percent * F.greatest("na", "nb")
    counted = F.zip_with("ma", "mb", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int"))
    apart = F.aggregate(counted, F.lit(0), lambda total, bits: total + bits)
    kept_of = lambda n: F.least(F.col(n), F.lit(join.retained))
    by_sketch = apart <= kept_of("na") + kept_of("nb") - 2 * F.least(F.lit(least_shared(join)), F.ceil(join.percent * F.greatest("na", "nb") / 100))
    whole_sets = (F.col("na") <= join.retained) & (F.col("nb") <= join.retained)
    by_set = (100 + join.percent) * apart <= (100 - join.percent) * (F.col("na") + F.col("nb"))
    return sizes & F.when(whole_sets, by_set).otherwise(by_sketch)


def _with_sketches(pairs: DataFrame, nodes: DataFrame, join: BottomK) -> DataFrame:
    """``pairs`` (a, b) that sizes and bit maps don't rule out, with (na, sa, nb, sb).

    A pivot with very many nodes is left to Spark, which splits the large side of a skewed join. Sketches of nodes that
    no pair is left of are not dealt.
    """
    small = lambda k: nodes.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"m{k}"))
    near = stored(pairs.join(small("a"), "a").join(small("b"), "b").where(_may_be_similar(join)).select("a", "b"), "bottom-pairs")
    ends = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    paired, _ = parted(nodes.select("node", "n", "sketch"), F.col("node"), ends)
    side = lambda k: paired.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("sketch").alias(f"s{k}"))
    return near.join(side("a"), "a").join(side("b"), "b")


#: Matches of a value from which on it is counted by matrices, and columns of a matrix.
_DENSE, _COLUMNS = 64, 2048
_NEAR = "a long, na long, b long, nb long, sure boolean"


class _Side:
    """Nodes of one side of a comparison: ids, sizes, classes, and all their retained values with their places."""

    def __init__(self, nodes: list[int], sizes: list[int], classes: list[int], sketches: list[bytes]):
        self.nodes, self.n, self.classes = np.array(nodes, np.int64), np.array(sizes, np.int64), np.array(classes, np.int64)
        self.sketches = [np.frombuffer(s, np.uint64) for s in sketches]
        self.values = np.concatenate(self.sketches)
        self.owner = np.repeat(np.arange(len(nodes)), [len(s) for s in self.sketches])

    def shared(self, other: _Side) -> np.ndarray:
        """How many retained values each pair has in common: inverted lists of one side against those of the other.

        Values that many pairs share are counted by products of incidence matrices, the others match by match.
        """
        common = np.intersect1d(self.values, other.values)
        out = np.zeros((len(self.nodes), len(other.nodes)), np.int64)
        if not len(common):
            return out
        (rows, at), (columns, of) = self._placed(common), other._placed(common)
        dense = np.bincount(at, minlength=len(common)) * np.bincount(of, minlength=len(common)) >= _DENSE
        place = np.cumsum(dense) - 1
        for first in range(0, int(dense.sum()), _COLUMNS):
            within = lambda k: dense[k] & (place[k] >= first) & (place[k] < first + _COLUMNS)  # noqa: B023, E731
            left, right = (np.zeros((n, _COLUMNS), np.float32) for n in out.shape)
            left[rows[within(at)], place[at[within(at)]] - first] = 1
            right[columns[within(of)], place[of[within(of)]] - first] = 1
            out += (left @ right.T).astype(np.int64)
        rows, at = rows[~dense[at]], at[~dense[at]]
        columns, of = columns[~dense[of]], of[~dense[of]]
        order = np.argsort(of, kind="stable")
        lo = np.searchsorted(of[order], at, "left")
        times = np.searchsorted(of[order], at, "right") - lo
        match = np.repeat(lo - np.cumsum(times) + times, times) + np.arange(times.sum())
        flat = np.bincount(np.repeat(rows, times) * out.shape[1] + columns[order[match]], minlength=out.size)
        return out + flat.reshape(out.shape)

    def _placed(self, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(owner, place in ``common``) of the values that are in it."""
        place = np.minimum(np.searchsorted(common, self.values), len(common) - 1)
        held = common[place] == self.values
        return self.owner[held], place[held]


def _union_shares(a: np.ndarray, b: np.ndarray, k: int) -> int:
    """Shared values among the ``k`` smallest of the union of two sketches."""
    both = np.intersect1d(a, b, assume_unique=True)
    union = np.union1d(a, b)
    return len(both) if len(union) <= k else int(np.searchsorted(both, union[k - 1], "right"))


def compared(a: _Side, b: _Side, join: BottomK, asked: int, same: bool) -> Iterator[tuple[int, int, int, int, bool]]:
    """(a, na, b, nb, sure) of the pairs of different classes that are similar for sure, or by the estimate."""
    shared = a.shared(b)
    na, nb = a.n[:, None], b.n[None, :]
    exact = (na <= join.retained) & (nb <= join.retained)
    apart = (a.classes[:, None] != b.classes[None, :]) & (100 * np.minimum(na, nb) >= join.percent * np.maximum(na, nb))
    if same:
        apart &= a.nodes[:, None] < b.nodes[None, :]
    sure = apart & exact & (100 * shared >= join.percent * (na + nb - shared))
    done = set()
    for i, j in np.argwhere(sure):
        # One link of a node with a class is enough.
        if (i, b.classes[j]) not in done:
            done.add((i, b.classes[j]))
            yield int(a.nodes[i]), int(a.n[i]), int(b.nodes[j]), int(b.n[j]), True
    for i, j in np.argwhere(apart & ~exact & (shared >= asked)):
        if (i, b.classes[j]) not in done and _union_shares(a.sketches[i], b.sketches[j], join.retained) >= asked:
            yield int(a.nodes[i]), int(a.n[i]), int(b.nodes[j]), int(b.n[j]), False


def _batch(found: list[tuple[int, int, int, int, bool]]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) if found else [[]] * 5
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, c, k in zip(("a", "na", "b", "nb", "sure"), columns, kinds, strict=True)})


def _estimated(pairs: DataFrame, nodes: DataFrame, join: BottomK) -> DataFrame:
    """The pairs (a, na, b, nb, sure) that the estimate lets through."""
    asked = least_shared(join)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for a, na, sa, b, nb, sb in zip(*(batch[c].to_pylist() for c in ("a", "na", "sa", "b", "nb", "sb")), strict=True):
                found += compared(_Side([a], [na], [0], [sa]), _Side([b], [nb], [1], [sb]), join, asked, False)
            yield _batch(found)

    return _with_sketches(pairs, nodes, join).select("a", "na", "sa", "b", "nb", "sb").mapInArrow(compare, _NEAR)


def _confirmed(near: DataFrame, documents: DataFrame, join: BottomK) -> DataFrame:
    """Links (a, b): what the sketches decide, and the rest confirmed on whole sets."""
    near = stored(near, "bottom-near")
    rest = near.where("not sure").drop("sure")
    links = near.where("sure").select("a", "b")
    if rest.isEmpty():
        return links
    sets = whole.sets_of(rest, documents, join.sets, "bottom")
    return stored(links.union(whole.verified(rest, sets, join.sets).select("a", "b")), "bottom-links")


def _pivot_pairs(lists: DataFrame, join: BottomK) -> DataFrame:
    """(a, b): a node and the pivots that it shares most lists with."""
    least = F.min(F.struct(F.xxhash64("node").alias("h"), "node"))["node"]
    pivots = lists.groupBy("value").agg(least.alias("b"))
    met = lists.join(pivots, "value").where("node <> b").groupBy(F.col("node").alias("a"), "b").count()
    best = W.partitionBy("a").orderBy(F.desc("count"), "b")
    return met.withColumn("place", F.row_number().over(best)).where(F.col("place") <= join.pivots).select("a", "b")


def _class_of(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """``lists`` with each node's class; lists within one class are left out. ``size`` is that of the list."""
    rows = lists.join(classes, "node", "left").withColumn("class", F.coalesce("component", "node")).drop("component")
    mixed_lists = rows.groupBy("value").agg(F.min("class").alias("lo"), F.max("class").alias("hi"), F.count("*").alias("size"))
    mixed_lists = stored(mixed_lists.where("lo <> hi").select("value", "size"), "bottom-open")
    return stored(rows.join(mixed_lists, "value"), "bottom-open-lists")


def _short_pairs(lists: DataFrame, join: BottomK) -> DataFrame:
    """(a, b): nodes of different classes that meet in a short list."""
    side = lambda k: lists.where(F.col("size") <= join.short_list).select("value", F.col("node").alias(k), F.col("class").alias(f"c{k}"))
    return side("a").join(side("b"), "value").where("ca <> cb and a < b").select("a", "b").distinct()


def _long_near(lists: DataFrame, nodes: DataFrame, join: BottomK) -> DataFrame:
    """Similar pairs from long lists. A node is in the block of its longest list; blocks that meet in a list are compared once.

    A block is a row, and so is a pair of blocks: what a list of m nodes costs in rows is the square of m / block_nodes.
    """
    long = lists.where(F.col("size") > join.short_list)
    home = long.groupBy("node", "class").agg(F.max(F.struct("size", F.col("value").alias("home"))).alias("h")).select("node", "class", "h.*")
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / F.lit(join.block_nodes)))
    home = stored(home.select("node", "class", F.xxhash64("home", part).alias("block")), "bottom-homes")
    held = F.collect_list(F.struct("node", "n", "class", "sketch")).alias("held")
    blocks = stored(home.join(nodes, "node").groupBy("block").agg(held), "bottom-blocks")
    met = long.join(home.select("node", "block"), "node").select("value", "block").distinct()
    side = lambda k: met.select("value", F.col("block").alias(k))
    pairs = side("a").join(side("b"), "value").where("a <= b").select("a", "b").distinct()
    one = pairs.join(blocks.select(F.col("block").alias("a"), F.col("held").alias("ha")), "a")
    both = one.join(blocks.select(F.col("block").alias("b"), F.col("held").alias("hb")), "b")
    asked = least_shared(join)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                sides = [_Side(*([m[f] for m in row[h]] for f in ("node", "n", "class", "sketch"))) for h in ("ha", "hb")]
                yield _batch(list(compared(*sides, join, asked, row["a"] == row["b"])))

    return both.select("a", "b", "ha", "hb").repartition("a", "b").mapInArrow(compare, _NEAR)


def _labelled(documents: DataFrame, join: BottomK) -> DataFrame:
    """(doc_id, n_shingles, node, class) of every row, ``class`` being the smallest node of its component."""
    profiles = stored(_profiles(documents, join), "bottom-profiles")
    lists = _lists(profiles)
    nodes = _nodes(documents, lists, join)

    first = _confirmed(_estimated(_pivot_pairs(lists, join), nodes, join), documents, join)
    apart = _class_of(lists, connected_components(first))
    rest = _estimated(_short_pairs(apart, join), nodes, join).union(_long_near(apart, nodes, join))
    second = _confirmed(rest, documents, join)

    classes = connected_components(first.union(second))
    rows = profiles.select("doc_id", "n_shingles", "node")
    linked, alone = parted(rows, F.coalesce("node", F.lit(0)), classes.select("node"))
    labelled = spread_join(linked, classes, "node", join.salts, "left").select(*rows.columns, F.coalesce("component", "node").alias("class"))
    return kept(labelled.union(alone.withColumn("class", F.col("node"))), "bottom-labelled")


def bottom_k_classes(documents: DataFrame, join: BottomK = BottomK()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row: the near-duplicate classes, one row of each kept.

    Two different sets are linked when 100 * intersection >= percent * union, on whole sets; the filters before
    miss a linked pair with a chance of ``risk``. Null and empty texts have no shingles, are linked with nothing and
    kept; equal texts and repeated rows are in one class; a class is named by its smallest doc_id (null if it has
    none), and the rows with that id are kept. Other columns are left out, an empty table gives an empty result.
    Sets are compared by 64-bit shingle hashes.
    """
    with working_tables(documents.sparkSession):
        labelled = _labelled(documents, join)
    own = labelled.where("class is not null")
    names = own.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    named = spread_join(own, names, "class", join.salts).select("doc_id", "n_shingles", "component_id")
    empty = labelled.where("class is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return named.union(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
