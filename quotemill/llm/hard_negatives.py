"""Hard-negative mining: rows of another label whose score with an anchor falls just below a positive's.

1. Rows and anchors are dealt to a grid of blocks, and a task scores one block of anchors with one block of rows.
   A first pass finds each anchor's positives, a second the rows of other labels that a window of theirs may want:
   the first few of each block, so that a block sends a bounded number of rows for an anchor, never all its scores.
2. Their scores are packed into keys (anchor, descending score, positives first, id) and sorted by the shuffle:
   ``repartitionAndSortWithinPartitions`` on the anchor.
3. An iterator streams over each sorted partition. A positive opens a window; a negative is emitted for every
   window that is open at its score and not full. State is one anchor's few windows, whatever the number of its rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from quotemill.llm.storage import kept, stored, working_tables


@dataclass(frozen=True)
class HardNegatives:
    positives: int = 5
    negatives: int = 5
    #: A negative's score is at least so many percent of its positive's, and not above it.
    percent: int = 80
    #: Anchors are the rows whose id this divides.
    anchor_every: int = 100
    #: Components are scaled by it and rounded down.
    scale: float = 256.0
    #: Most anchors and rows of a block, on average.
    anchor_block: int = 2048
    row_block: int = 16384


#: Scaled components are held within this, so that a score of up to 512 components is a 64-bit number.
_LARGEST = float(1 << 27)
_PAIR = "anchor_id long, anchor long, flipped long, negative int, vec_id long"
_RESULT = StructType(
    [StructField(n, IntegerType() if n == "rank" else LongType()) for n in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")]
)


def relabelled(vec_id: Column, label: Column) -> Column:
    """The label that mining goes by: of every seventh id the next one of ten."""
    return F.when(vec_id % 7 == 0, (label.cast("long") + 1) % 10).otherwise(label.cast("long"))


def scaled_vectors(embeddings: DataFrame, mining: HardNegatives) -> DataFrame:
    """(vec_id, label, vec) of the rows that take part, with whole numbers as components."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.greatest(F.least(F.floor(x.cast("double") * mining.scale).cast("double"), F.lit(_LARGEST)), F.lit(-_LARGEST)))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(usable, F.lit(False)))
    return rows.select("vec_id", relabelled(F.col("vec_id"), F.col("label")).alias("label"), whole.alias("vec"))


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """The vectors as rows; a shorter one ends in zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors.to_pylist()):
        out[i, : len(v)] = v
    return out


def _width(*columns: pa.ChunkedArray) -> int:
    return max([1, *(len(v) for c in columns for v in c.to_pylist())])


def score_matrix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles while they hold every whole number that can occur."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    return (a @ b.T).astype(np.int64) if most < 2**53 else a.astype(np.int64) @ b.T.astype(np.int64)


def _first(scores: np.ndarray, ids: np.ndarray, where: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` of ``where`` by descending score and ascending id."""
    if len(where) > n:
        # All that tie with the n-th stay until the ids decide.
        cut = np.partition(scores[where], len(where) - n)[len(where) - n]
        where = where[scores[where] >= cut]
    return where[np.lexsort((ids[where], -scores[where]))[:n]]


def _scored(anchors: pa.Table, rows: pa.Table, mining: HardNegatives, windows: bool) -> pa.Table:
    """The pairs of one block of anchors with one block of rows that can matter."""
    found: list[tuple[int, int, int, int, int]] = []
    if anchors.num_rows and rows.num_rows:
        width = _width(anchors["vec"], rows["vec"])
        right = _matrix(rows["vec"], width)
        ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        tops = anchors["tops"].to_pylist() if windows else None
        names, keys, own = (anchors[c].to_pylist() for c in ("vec_id", "anchor", "label"))
        for first in range(0, anchors.num_rows, 256):
            some = slice(first, min(first + 256, anchors.num_rows))
            scores = score_matrix(_matrix(anchors["vec"].slice(first, some.stop - first), width), right)
            for i in range(first, some.stop):
                line, same = scores[i - first], labels == own[i]
                others = ids != names[i]
                for k in _first(line, ids, np.flatnonzero(same & others), mining.positives):
                    found.append((names[i], keys[i], -int(line[k]), 0, int(ids[k])))
                wanted: set[int] = set()
                for top in sorted(set(tops[i])) if windows else ():
                    within = ~same & (line <= top) & (line >= -(-mining.percent * top // 100))
                    wanted.update(_first(line, ids, np.flatnonzero(within), mining.negatives).tolist())
                found += [(names[i], keys[i], -int(line[k]), 1, int(ids[k])) for k in sorted(wanted)]
    columns = list(zip(*found, strict=True)) if found else [[]] * 5
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
    return pa.table({n: pa.array(c, k) for n, c, k in zip(("anchor_id", "anchor", "flipped", "negative", "vec_id"), columns, kinds, strict=True)})


def mined(pairs: Iterable[tuple[tuple[int, int, int, int, int], None]], mining: HardNegatives) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Rows of the result from pairs sorted by (anchor, anchor id, flipped score, negative, id)."""
    anchor, n_positives = None, 0
    windows: list[list[int]] = []  # positive's id, its score, negatives emitted
    for (key, name, flipped, negative, vec_id), _ in pairs:
        score = -flipped
        if (key, name) != anchor:
            anchor, n_positives, windows = (key, name), 0, []
        if not negative:
            if n_positives < mining.positives:
                n_positives += 1
                windows.append([vec_id, score, 0])
            continue
        # Scores only fall from here on: a window that is full or passed never takes a row again.
        windows = [w for w in windows if w[2] < mining.negatives and mining.percent * w[1] <= 100 * score]
        for w in windows:
            w[2] += 1
            yield name, w[0], w[2], vec_id, w[1], score


def mine_hard_negatives(embeddings: DataFrame, mining: HardNegatives = HardNegatives()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive.

    Rows with a null id, label or vector, or a component that is null or not finite, take no part. A row with an
    anchor's own id is neither its positive nor its negative. Repeated rows count as often as they stand; rows that
    share an id tie and both stay; an anchor that stands twice with equal vector and label is one anchor. Scores that
    tie go by id. Vectors of different lengths are compared as if the shorter one ended in zeros; scaled components
    are held within +-2**27. An anchor without positives, and a window without rows, give no rows; so does an empty
    table. Other columns are left out.
    """
    spark = embeddings.sparkSession
    with working_tables(spark):
        rows = stored(scaled_vectors(embeddings, mining), "mining-vectors")
        key = F.xxhash64("vec_id", "label", "vec").alias("anchor")
        anchors = rows.where(F.col("vec_id") % mining.anchor_every == 0).select("*", key).dropDuplicates(["vec_id", "anchor"])
        anchors = stored(anchors, "mining-anchors")
        parts = lambda df, size: max(1, -(-df.count() // size))
        high, wide = parts(anchors, mining.anchor_block), parts(rows, mining.row_block)
        steps = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
        row_cells = rows.select("*", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(wide)).cast("long").alias("col"), steps(high).alias("line"))

        def pairs(of: DataFrame, windows: bool) -> DataFrame:
            cells = of.select("*", F.pmod("anchor", F.lit(high)).cast("long").alias("line"), steps(wide).alias("col"))
            both = cells.groupBy("line", "col").cogroup(row_cells.groupBy("line", "col"))
            return both.applyInArrow(partial(_scored, mining=mining, windows=windows), _PAIR)

        best = pairs(anchors, False)
        by_anchor = W.partitionBy("anchor", "anchor_id").orderBy("flipped", "vec_id")
        best = best.withColumn("place", F.row_number().over(by_anchor)).where(F.col("place") <= mining.positives)
        tops = best.groupBy("anchor", F.col("anchor_id").alias("vec_id")).agg(F.collect_list(-F.col("flipped")).alias("tops"))
        wanted = stored(pairs(anchors.join(tops, ["anchor", "vec_id"]), True), "mining-pairs")

        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        packed = wanted.select("anchor", "anchor_id", "flipped", "negative", "vec_id").rdd.map(lambda r: (tuple(r), None))
        ordered = packed.repartitionAndSortWithinPartitions(n, lambda k: hash(k[:2]))
        return kept(spark.createDataFrame(ordered.mapPartitions(partial(mined, mining=mining)), _RESULT), "mining-negatives")
