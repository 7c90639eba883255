"""N-gram Jaccard join by a token-group matrix: which documents are linked, as connected classes.

1. Texts become sets of 5-word shingle hashes; equal sets are one node.
2. A node's rarest shingles (by a fixed-size counter table over all texts) are its prefix. Two sets with a
   Jaccard similarity of t share a shingle of their prefixes, for any one order of all shingles.
3. Similar nodes are brought into groups: nodes with equal pairs of min-hashes are compared with a few pivots,
   and what links to one joins its group. Groups are cut into parts of bounded size.
4. The token-group matrix has a row for a shingle and a part of a group. A node is compared with a part only
   if they are in different classes and a prefix shingle meets; the part's token union bounds the overlap,
   and only parts that can reach the threshold are opened, set against set.

Token sets and unions are bit maps of fixed size until a pair is left to be verified: a bit that only one of two
sets has is a shingle that only one has, which bounds the overlap from above. Whole sets are read again from
the texts for those pairs alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.llm.components import connected_components
from quotemill.llm.folded import bloom_of, folded, parted
from quotemill.llm.joins import spread_join
from quotemill.llm.storage import kept, stored, working_tables
from quotemill.llm.tokens import Words, as_bytes, groups_of, int64_list, mixed, multipliers, window_hashes


@dataclass(frozen=True)
class JaccardJoin:
    shingle_words: int = 5
    percent: int = 75
    #: Counters of the shingle order; most members of a part of a group.
    counters: int = 1 << 20
    #: 64-bit words of a set's bit map.
    map_words: int = 16
    #: Pivots of a min-hash key.
    pivots: int = 3
    part_members: int = 64
    #: Texts of which a task remembers the node, to send equal texts once.
    remembered: int = 200_000
    #: Parts that the rows of one class are dealt to where its name is joined to them.
    salts: int = 8


def shingle_sets(words: Words, n: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, in order; a text of fewer words is one shingle, of none: none."""
    windows = window_hashes(words.hashes, tuple(range(n))) if len(words.hashes) >= n else np.zeros(0, np.uint64)
    for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        if b - a >= n:
            yield np.unique(windows[a : b - n + 1])
        elif b > a:
            yield window_hashes(words.hashes[a:b], tuple(range(b - a)), salt=int(b - a))
        else:
            yield np.zeros(0, np.uint64)


def node_of(shingles: np.ndarray) -> int:
    """A 64-bit name of the set, as a signed number."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).view(np.int64))


def bit_map(shingles: np.ndarray, n_words: int) -> np.ndarray:
    """``n_words`` 64-bit words in which each shingle sets a bit."""
    bits = np.zeros(n_words * 64, dtype=np.uint8)
    bits[((shingles >> np.uint64(20)) & np.uint64(n_words * 64 - 1)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _bits(a: Column, b: Column, pick) -> Column:
    counted = F.zip_with(a, b, lambda x, y: F.bit_count(pick(x, y)).cast("int"))
    return F.aggregate(counted, F.lit(0), lambda s, v: s + v)


def may_be_similar(n_a: Column, n_b: Column, a: Column, b: Column, percent: int) -> Column:
    """False only for sets that can't be: bits of one set alone are shingles of one set alone."""
    apart = _bits(a, b, lambda x, y: x.bitwiseXOR(y))
    return (100 + percent) * apart <= (100 - percent) * (n_a + n_b)


def may_be_covered(n: Column, bits: Column, union: Column, percent: int) -> Column:
    """False only if fewer than ``percent`` of the shingles of a set can be in the union."""
    return 100 * _bits(bits, union, lambda x, y: x.bitwiseAND(F.bitwise_not(y))) <= (100 - percent) * n


def similar(n_a: Column, n_b: Column, both: Column, percent: int) -> Column:
    return 100 * both >= percent * (n_a + n_b - both)


def _sketch(documents: DataFrame, join: JaccardJoin) -> np.ndarray:
    def cells(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for words in groups_of(as_bytes(batch["text"])):
            for s in shingle_sets(words, join.shingle_words):
                yield (s & np.uint64(join.counters - 1)).astype(np.int64)

    def joined(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        found = list(cells(batch))
        for k in range(0, len(found), 1024):
            yield np.concatenate(found[k : k + 1024])

    return folded(documents.select("text"), join.counters, joined)


def _profiles(documents: DataFrame, join: JaccardJoin) -> DataFrame:
    """(doc_id, n_shingles, node, keys, prefix); keys and prefix only once for a node and task."""
    counts = documents.sparkSession.sparkContext.broadcast(_sketch(documents, join))
    odd = multipliers(4)
    couples = [(i, k) for i in range(4) for k in range(i + 1, 4)]

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, seen = counts.value, set()
        for batch in batches:
            n, nodes, keys, prefixes, maps = [], [], [], [], []
            for words in groups_of(as_bytes(batch["text"])):
                for s in shingle_sets(words, join.shingle_words):
                    n.append(len(s))
                    node = node_of(s) if len(s) else None
                    nodes.append(node)
                    if node is None or node in seen:
                        keys.append(None)
                        prefixes.append(None)
                        maps.append(None)
                        continue
                    if len(seen) >= join.remembered:
                        seen.clear()
                    seen.add(node)
                    least = [int(mixed(s * m).min()) for m in odd]
                    keys.append([hash((i, k, least[i], least[k])) for i, k in couples])
                    maps.append(bit_map(s, join.map_words))
                    order = np.lexsort((s, count[(s & np.uint64(join.counters - 1)).astype(np.int64)]))
                    need = (join.percent * len(s) + 99) // 100
                    prefixes.append(s[order[: len(s) - need + 1]].view(np.int64))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "n_shingles": pa.array(n, pa.int64()),
                    "node": pa.array(nodes, pa.int64()),
                    "keys": pa.array(keys, pa.list_(pa.int64())),
                    "prefix": pa.array(prefixes, pa.list_(pa.int64())),
                    "bits": pa.array(maps, pa.list_(pa.int64())),
                }
            )

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(profile, "doc_id long, n_shingles long, node long, keys array<long>, prefix array<long>, bits array<long>")


def _sets(documents: DataFrame, wanted: DataFrame, join: JaccardJoin) -> DataFrame:
    """(node, n, tokens) of the nodes in ``wanted`` (node), read again from the texts."""
    shared = documents.sparkSession.sparkContext.broadcast(bloom_of(wanted))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled, seen = shared.value, set()
        for batch in batches:
            for words in groups_of(as_bytes(batch["text"])):
                sets = [s for s in shingle_sets(words, join.shingle_words) if len(s)]
                nodes = np.array([node_of(s) for s in sets], dtype=np.int64)
                keep = np.flatnonzero(filled.may_hold(nodes.view(np.uint64)))
                new = []
                for k in keep:
                    if int(nodes[k]) not in seen:
                        if len(seen) >= join.remembered:
                            seen.clear()
                        seen.add(int(nodes[k]))
                        new.append(k)
                if new:
                    yield pa.RecordBatch.from_pydict(
                        {
                            "node": pa.array(nodes[new]),
                            "n": pa.array([len(sets[k]) for k in new], pa.int64()),
                            "tokens": int64_list([sets[k] for k in new]),
                        }
                    )

    found = documents.select("text").mapInArrow(tokens, "node long, n long, tokens array<long>")
    return stored(found.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "jaccard-sets")


def _overlap(a: str, b: str) -> Column:
    return F.size(F.array_intersect(a, b)).cast("long")


def _pivot_pairs(profiles: DataFrame, join: JaccardJoin) -> DataFrame:
    """(turn, a, b): a node and a pivot of one of its min-hash keys; a key has a pivot for each turn."""
    keyed = profiles.where("keys is not null").select("node", F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
    chosen = [F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("h"), "node", "n")).alias(f"p{k}") for k in range(join.pivots)]
    pivots = keyed.groupBy("key").agg(*chosen, F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi")
    turns = F.array(*[F.struct(F.lit(k).alias("turn"), F.col(f"p{k}.node").alias("b"), F.col(f"p{k}.n").alias("n_b")) for k in range(join.pivots)])
    pairs = keyed.join(pivots.select("key", turns.alias("turns")), "key").select(F.col("node").alias("a"), "n", F.inline("turns"))
    sizes = 100 * F.least("n", "n_b") >= join.percent * F.greatest("n", "n_b")
    return pairs.where((F.col("a") != F.col("b")) & sizes).groupBy("a", "b").agg(F.min("turn").alias("turn"))


def _near(pairs: DataFrame, nodes: DataFrame, join: JaccardJoin, label: str) -> DataFrame:
    """``pairs`` (a, b, ...) with sizes na and nb, without those that the bit maps rule out."""
    side = lambda k: nodes.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"m{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    near = both.where(may_be_similar(F.col("na"), F.col("nb"), F.col("ma"), F.col("mb"), join.percent))
    return stored(near.drop("ma", "mb"), f"jaccard-{label}-pairs")


def sets_of(near: DataFrame, documents: DataFrame, join: JaccardJoin, label: str) -> DataFrame:
    wanted = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    return _sets(documents, stored(wanted, f"jaccard-{label}-wanted"), join)


def verified(near: DataFrame, sets: DataFrame, join: JaccardJoin) -> DataFrame:
    """The pairs (a, b, na, nb) whose whole sets are similar."""
    both = near.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b")
    return both.where(similar(F.col("na"), F.col("nb"), _overlap("ta", "tb"), join.percent))


def _apart(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs`` whose two nodes are not in one class yet."""
    side = lambda k: classes.select(F.col("node").alias(k), F.col("component").alias(f"c{k}"))
    both = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return both.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).drop("ca", "cb")


def _grouped(profiles: DataFrame, nodes: DataFrame, documents: DataFrame, join: JaccardJoin) -> tuple[DataFrame, DataFrame]:
    """Links to pivots, and the classes that they make. After the first pivot only what is still apart is compared."""
    near = _near(_pivot_pairs(profiles, join), nodes, join, "pivot")
    sets = sets_of(near, documents, join, "pivot")
    first = verified(near.where("turn = 0").drop("turn"), sets, join).select("a", "b")
    first = stored(first, "jaccard-pivot-links")
    rest = _apart(near.where("turn > 0").drop("turn"), connected_components(first))
    links = first.union(stored(verified(rest, sets, join).select("a", "b"), "jaccard-pivot-links"))
    classes = connected_components(links)
    return links, classes


def _of_several(rows: DataFrame, name: str) -> DataFrame:
    """The rows of tokens that have more than one ``name``: grouped ends of each token, and a join that Spark can split."""
    ends = rows.groupBy("token").agg(F.min(name).alias("lo"), F.max(name).alias("hi")).where("lo <> hi").select("token")
    ends = stored(ends, "jaccard-tokens")
    likely, _ = parted(rows, F.col("token"), ends)
    return likely.join(ends, "token")


def _labelled(documents: DataFrame, join: JaccardJoin) -> DataFrame:
    """(doc_id, n_shingles, node, class) of every row, ``class`` being the smallest node of its component."""
    profiles = stored(_profiles(documents, join), "jaccard-profiles")
    prefix = profiles.where("prefix is not null").select("node", "n_shingles", F.posexplode("prefix").alias("place", "token"))
    # What a set has from this shingle on bounds the overlap of two sets that meet in it first.
    prefix = prefix.select("token", "node", (F.col("n_shingles") - F.col("place")).alias("rest"))
    postings = stored(_of_several(prefix, "node").select("token", "node", "rest").distinct(), "jaccard-postings")
    nodes = profiles.where("bits is not null").dropDuplicates(["node"])
    nodes = stored(nodes.select("node", F.col("n_shingles").alias("n"), "bits"), "jaccard-nodes")

    first, grouped = _grouped(profiles, nodes, documents, join)
    members = postings.select("node").distinct().join(nodes, "node").join(grouped, "node", "left")
    members = members.withColumn("component", F.coalesce("component", "node"))
    sizes = members.groupBy("component").agg(F.count("*").alias("members"))
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / F.lit(join.part_members)))
    members = spread_join(members, sizes, "component", join.salts).select("node", "n", "bits", "component", part.alias("part"))
    members = stored(members, "jaccard-members")

    placed = postings.join(members.select("node", "n", "component", "part"), "node")
    matrix = stored(_of_several(placed, "component"), "jaccard-matrix")
    columns = matrix.groupBy("token", "component", "part").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("rest").alias("most_rest"))
    columns = columns.select("token", F.col("component").alias("of"), F.col("part").alias("of_part"), "least", "most", "most_rest")
    need = join.percent * (F.col("n") + F.col("least"))
    meets = matrix.join(columns, "token").where(
        (F.col("component") > F.col("of"))
        & (100 * F.col("most") >= join.percent * F.col("n"))
        & (100 * F.col("n") >= join.percent * F.col("least"))
        & ((100 + join.percent) * F.col("rest") >= need)
        & ((100 + join.percent) * F.col("most_rest") >= need)
    )
    queries = meets.select("node", "of", "of_part").distinct()
    # A part of a group is one row: its union, and its members to open it with. Only pairs that the maps leave are rows.
    ors = F.array(*[F.bit_or(F.col("bits")[k]) for k in range(join.map_words)])
    held = F.collect_list(F.struct("node", "n", "bits")).alias("held")
    parts = members.groupBy(F.col("component").alias("of"), F.col("part").alias("of_part")).agg(ors.alias("union"), held)
    bounded = queries.join(nodes, "node").join(parts, ["of", "of_part"])
    bounded = bounded.where(may_be_covered(F.col("n"), F.col("bits"), F.col("union"), join.percent))
    opened = F.filter("held", lambda m: may_be_similar(F.col("n"), m["n"], F.col("bits"), m["bits"], join.percent))
    left = F.transform(opened, lambda m: F.struct(m["node"].alias("b"), m["n"].alias("nb")))
    near = bounded.select(F.col("node").alias("a"), F.col("n").alias("na"), "of", F.inline(left))
    near = stored(near, "jaccard-group-pairs")
    found = verified(near, sets_of(near, documents, join, "group"), join)
    # One link of a node with a class is enough.
    second = stored(found.groupBy("a", "of").agg(F.min("b").alias("b")).select("a", "b"), "jaccard-group-links")

    classes = connected_components(first.union(second))
    rows = profiles.select("doc_id", "n_shingles", "node")
    linked, alone = parted(rows, F.coalesce("node", F.lit(0)), classes.select("node"))
    labelled = spread_join(linked, classes, "node", join.salts, "left").select(*rows.columns, F.coalesce("component", "node").alias("class"))
    return kept(labelled.union(alone.withColumn("class", F.col("node"))), "jaccard-labelled")


def jaccard_classes(documents: DataFrame, join: JaccardJoin = JaccardJoin()) -> DataFrame:
    """(doc_id, n_shingles, node, component_id) of every row: the classes of the Jaccard join.

    Exact: two different sets are linked when 100 * intersection >= percent * union. Null and empty texts
    have no shingles and are linked with nothing; equal texts and repeated rows are in one class; a class is
    named by its smallest doc_id (null if it has none). Other columns are left out, an empty table gives an
    empty result. Sets are compared by 64-bit shingle hashes.
    """
    with working_tables(documents.sparkSession):
        labelled = _labelled(documents, join)
    names = labelled.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("component_id"))
    named = spread_join(labelled.where("class is not null"), names, "class", join.salts).select("doc_id", "n_shingles", "node", "component_id")
    empty = labelled.where("class is null").select("doc_id", "n_shingles", "node", F.col("doc_id").alias("component_id"))
    return named.union(empty)
