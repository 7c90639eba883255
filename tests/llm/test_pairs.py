"""Spelling variants, bottom-k classes and hard negatives against brute force, and on odd rows."""

from collections import Counter
from itertools import product
from random import Random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.llm.bottom_k import BottomK, bottom_k_classes, least_shared, listed_values, sketch_of
from quotemill.llm.hard_negatives import HardNegatives, mine_hard_negatives, mined
from quotemill.llm.spelling import Spelling, near_words, signatures, spelling_variants, vector_of

CLASHING = ("word", "n", "value", "node", "class", "anchor", "label_", "tops", "size_")


def clashing(df):
    return df.withColumns({c: F.lit(1) for c in CLASHING if c not in df.columns})


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


@pytest.mark.parametrize(("parts", "subparts"), [(1, 6), (2, 4), (3, 1)])
def test_op11_similar_vectors_share_a_signature(parts, subparts):
    r, spelling = Random(parts), Spelling(parts=parts, subparts=subparts)
    for _ in range(2000):
        word = "".join(r.choice("aabcdeé") for _ in range(r.randrange(1, 12)))
        at = r.randrange(len(word))
        for other in (word[:at] + word[at + 1 :], word[:at] + r.choice("xa") + word[at:], word[:at] + r.choice("xb") + word[at + 1 :]):
            mine, its = (set(signatures(vector_of("".join(sorted(w))), spelling)) for w in (word, other))
            assert mine & its


def test_op11_near_words_equal_all_pairs(spark):
    r = Random(5)
    words = sorted({"".join(r.choice("abé") for _ in range(r.randrange(4, 8))) for _ in range(500)})
    want = {(a, b) for a, b in product(words, words) if a != b and one_edit(a, b)}
    rows = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    # Small limits, so that groups of equal letters are cut and signatures are dealt to parts.
    got = near_words(rows, Spelling(group_words=3, signature_rows=4)).collect()
    assert {(x.word, x.other) for x in got} == want and len(got) == len(want)


def test_op11_forms_and_roots(spark):
    uses = {"wonderful": 1000, "wonderfull": 100, "wonderfuull": 10, "wondarful": 101, "anderes": 2, "anderer": 20, "anderem": 20, "kürzeste": 2, "kurzeste": 19}
    text = " ".join(w for w, n in uses.items() for _ in range(n))
    # One of 31 runs of a document loses a letter: of ids whose runs lose none here.
    from zlib import crc32

    ids = [i for i in range(2000) if all(crc32(f"{i}:{w}".encode()) % 31 for w in uses)][:1]
    got = {x.word: x for x in spelling_variants(spark.createDataFrame([(ids[0], text)], "doc_id long, text string")).collect()}
    assert {w: x.n for w, x in got.items()} == uses
    assert (got["wonderfuull"].form, got["wonderfuull"].root, got["wonderfuull"].form_n) == ("wonderfull", "wonderful", 100)
    assert (got["wondarful"].form, got["wondarful"].root, got["wondarful"].n_near) == (None, "wondarful", 1)
    assert (got["anderes"].form, got["anderes"].n_near) == ("anderem", 2)  # ties: the first in code-point order
    assert got["kürzeste"].form is None and got["kürzeste"].n_near == 1 and got["kurzeste"].root == "kurzeste"


def test_op11_odd_rows(spark):
    from zlib import crc32

    run = next(w for w in (f"letters{a}{b}" for a in "abcdefghij" for b in "klmnopqrst") if not crc32(f":{w}".encode()) % 31)
    place = crc32(f":{run}".encode()) % len(run)
    rows = [(None, f"{run} {run.upper()}"), (1, None), (2, ""), (3, "short ones"), (4, "Äußeres×÷ ÄußereS×÷"), (5, "x" * 50_000), (5, "x" * 50_000)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {x.word: x.n for x in spelling_variants(df).collect()}
    longest = "x" * (50_000 - (crc32(f"5:{'x' * 50_000}".encode()) % 31 == 0))
    assert got == {run[:place] + run[place + 1 :]: 2, "Äußeres×÷": 2, longest: 2}
    assert spelling_variants(df.limit(0)).count() == 0


def shingles(text, n=4):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def classes_of(texts, percent=80):
    """By comparing all pairs: (size of the set, smallest id reachable) of each id."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in product(sets, sets):
        both = len(sets[a] & sets[b])
        if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in texts}


@pytest.mark.parametrize("join", [BottomK(), BottomK(retained=96, short_list=4, block_nodes=16)])
def test_op12_classes_equal_all_pairs(spark, join):
    """Groups of copies with more and more other words: in one group all pairs are near the threshold."""
    r, texts = Random(7), {}
    for group in range(6):
        base = [f"g{group}w{r.randrange(400)}" for _ in range(r.choice((30, 120, 400)))]
        for _ in range(40):
            rate = r.choice((0, 0.01, 0.02, 0.03, 0.05))
            texts[len(texts)] = " ".join(f"x{r.random()}" if r.random() < rate else w for w in base)
    for k in range(60):  # a passage that many texts share, and own words
        texts[len(texts)] = " ".join([f"p{i}" for i in range(150)] + [f"own{k}a{i}" for i in range(r.choice((10, 60, 300)))])
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in bottom_k_classes(rows, join).collect()}
    assert got == classes_of(texts)


def test_op12_similar_sets_meet_in_a_list():
    r, join = np.random.default_rng(1), BottomK(retained=64, risk=1e-6, counters=1 << 16)
    for _ in range(300):
        n = int(r.integers(1, 400))
        a = r.integers(0, 1 << 62, n).astype(np.uint64)
        b = np.concatenate([a[: n - int(0.1 * n)], r.integers(0, 1 << 62, int(0.1 * n)).astype(np.uint64)])
        if 100 * len(np.intersect1d(a, b)) < 80 * len(np.union1d(a, b)):
            continue
        counts = np.full(join.counters, 2, np.uint32)
        counts[: 1 << 15] = 9
        one, two = (listed_values(sketch_of(np.unique(x), join), len(x), counts, join, least_shared(join)) for x in (a, b))
        assert len(np.intersect1d(one, two))


def test_op12_odd_rows(spark):
    long = " ".join(f"w{i % 977} x{i}" for i in range(60_000))
    rows = [(5, None), (6, ""), (7, " \n "), (8, "a b"), (9, "A  B"), (9, "A  B"), (3, long), (2, long + " end"), (None, "one two three four"), (4, "one two three four")]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = Counter(tuple(x) for x in bottom_k_classes(df).collect())
    n = len(shingles(long))
    assert got == Counter({(5, 0, 5, True): 1, (6, 0, 6, True): 1, (7, 0, 7, True): 1, (8, 1, 8, True): 1, (9, 1, 8, False): 2, (3, n, 2, False): 1,
                           (2, n + 1, 2, True): 1, (None, 1, 4, False): 1, (4, 1, 4, True): 1})
    assert bottom_k_classes(df.limit(0)).count() == 0


def test_op12_deals_sketches_of_paired_nodes_only(spark, monkeypatch):
    """Pairs that sizes or bit maps rule out bring no sketches: of a hundred nodes that meet, the two that may be similar."""
    from quotemill.llm import bottom_k as bk

    dealt, parted = [], bk.parted

    def watched(df, *rest):
        likely, others = parted(df, *rest)
        dealt.append(sorted(x.node for x in likely.collect()))
        return likely, others

    monkeypatch.setattr(bk, "parted", watched)
    join, r = BottomK(), np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 1 << 62, 100).astype(np.uint64)) for _ in range(100)]
    sets[1] = np.append(sets[0][1:], np.uint64(7))
    sketches = [sketch_of(s, join) for s in sets]
    rows = [(k, len(s), s.tobytes(), bk.whole.bit_map(s, join.map_words).tolist()) for k, s in enumerate(sketches)]
    nodes = spark.createDataFrame(rows, "node long, n long, sketch binary, bits array<long>")
    pairs = spark.createDataFrame([(a, b) for a in range(10) for b in range(a + 1, 100)], "a long, b long")
    got = bk._with_sketches(pairs, nodes, join).collect()
    assert [(x.a, x.b, bytes(x.sa), bytes(x.sb)) for x in got] == [(0, 1, rows[0][2], rows[1][2])]
    assert len(dealt) == 1 and {0, 1} <= set(dealt[0]) and len(dealt[0]) < 10


def negatives(rows, m):
    """By scoring all pairs."""
    use = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            use.append((i, [int(np.floor(m.scale * float(np.float32(x)))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for a, va, la in {(i, tuple(v), y) for i, v, y in use if i % m.anchor_every == 0}:
        scored = sorted((-sum(x * y for x, y in zip(va, v, strict=False)), i, y) for i, v, y in use if i != a)
        for p, pos, _ in [s for s in scored if s[2] == la][: m.positives]:
            fit = [s for s in scored if s[2] != la and m.percent * -p <= 100 * -s[0] <= 100 * -p][: m.negatives]
            out += [(a, pos, k + 1, i, -p, -s) for k, (s, i, _) in enumerate(fit)]
    return Counter(out)


def test_op13_equals_all_pairs(spark):
    r = Random(4)
    rows = [(i, [r.choice((-0.5, 0.0, 0.25, 0.5, 1e-3)) for _ in range(4)], r.randrange(3)) for i in range(400)]  # many ties
    rows += [(i, [0.1, None, 0.2, 0.3], 1) for i in (500, 501)] + [(502, None, 1), (600, [float("nan"), 0.0, 0.0, 0.0], 2), (601, [float("inf"), 0.0, 0.0, 0.0], 2)]
    rows += [(None, [0.5] * 4, 1), (603, [0.5] * 4, None), (604, [0.5, 0.5], 1), (605, [], 2), (700, [], 2), rows[3], rows[100], rows[50]]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    for m in (HardNegatives(), HardNegatives(anchor_every=10, anchor_block=7, row_block=30)):
        assert Counter(tuple(x) for x in mine_hard_negatives(df, m).collect()) == negatives(rows, m)
    assert mine_hard_negatives(df.limit(0)).count() == 0


def test_op13_large_components_are_exact(spark):
    big = 2.0**19
    rows = [(0, [big, 1.0], 1), (1, [big, 2.0], 1), (2, [big, 1.5], 2), (3, [big, 1.25], 2), (4, [-1e30, 0.0], 3)]
    got = mine_hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert [(x.negative_id, x.negative_score) for x in got] == []  # vec 0 is relabelled 2 of 10: its positives are 2 and 3
    rows[0] = (100, [big, 1.0], 1)
    got = mine_hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    whole = int(big * 256) ** 2
    assert [(x.positive_id, x.negative_id, x.positive_score - whole, x.negative_score - whole) for x in got] == [(1, 2, 131072, 98304), (1, 3, 131072, 81920)]


def test_op13_iterator_keeps_windows_only():
    key = lambda score, negative, i: ((1, 100, -score, negative, i), None)
    pairs = [key(12, 1, 1), key(10, 0, 2), key(10, 1, 3), key(9, 1, 4), key(9, 0, 5), key(8, 1, 6), key(7, 1, 7)]
    m = HardNegatives(negatives=2)
    assert list(mined(iter(sorted(pairs)), m)) == [(100, 2, 1, 3, 10, 10), (100, 2, 2, 4, 10, 9), (100, 5, 1, 4, 9, 9), (100, 5, 2, 6, 9, 8)]
