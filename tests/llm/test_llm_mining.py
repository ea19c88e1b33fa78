"""Substring dedup, hard negatives and lexical search against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import docs_of, rows_of, with_clashes
from pyspark.sql import functions as F

from cohortine.llm import covertree, lexical, substrings

VECTORS = "vec_id bigint, label int, vector array<bigint>"


def slow_removal(rows, window):
    """(id, words, removed, kept) of every row, by comparing all windows."""
    first = {}
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    for i, words in split:
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, words in split:
        gone = set()
        for at in range(len(words) - window + 1):
            owner = first.get(tuple(words[at : at + window]))
            if owner is not None and (i is None or owner < i):
                gone.update(range(at, at + window))
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        out.append((i, len(words), len(gone), kept))
    return sorted(out, key=repr)


def passages(seed, n=40):
    """Documents put together from a few passages, with repeats, nulls and repeated ids."""
    rng = random.Random(seed)
    parts = [[rng.choice("abcdé") + str(rng.randint(0, 9)) for _ in range(rng.randint(1, 30))] for _ in range(12)]
    rows = [(1, None), (2, ""), (3, " \n"), (None, None)]
    for i in range(10, 10 + n):
        words = [w for _ in range(rng.randint(1, 6)) for w in rng.choice(parts)]
        rows.append((rng.choice([i, i, 7, None]), rng.choice(" \t\n").join(words)))
    return rows + rows[-5:]


@pytest.mark.parametrize("window,cells", [(2, 8), (5, 1 << 12), (8, 64), (50, 1 << 20)])
def test_passages_equal_brute_force(spark, window, cells):
    rows = passages(window)
    docs = with_clashes(docs_of(spark, rows))
    got = substrings.remove_repeated_passages(docs, window, cells)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept") == slow_removal(rows, window)
    digests = substrings.remove_repeated_passages(docs, window, cells, with_text=False)
    want = [(i, n, r, hashlib.sha256(k.encode()).hexdigest()) for i, n, r, k in slow_removal(rows, window)]
    assert rows_of(digests, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want, key=repr)


def test_common_passage_and_long_text(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HOT_SHARE", 0.0)
    common = " ".join(f"w{i}" for i in range(60))
    long = " ".join(str(i * i % 99_991) for i in range(200_000))
    rows = [(i, f"x{i} {common} y{i}") for i in range(300)] + [(900, long), (901, f"z {long}")]
    got = {r.doc_id: (r.n_removed, r.kept) for r in substrings.remove_repeated_passages(docs_of(spark, rows)).collect()}
    assert got[0] == (0, rows[0][1]) and got[900] == (0, long)
    assert all(got[i] == (60, f"x{i} y{i}") for i in range(1, 300))
    assert got[901] == (200_000, "z")


def test_sketch_never_loses(spark):
    """Whatever the size of the sketch, anchors in two texts are estimated at two or more."""
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.randint(1, 40))) for _ in range(60)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    found = [set(substrings.Windows([t.encode()], substrings.WordHashes(), 6).anchors().tolist()) for t in texts]
    counts = Counter(a for one in found for a in one)
    every = np.array(sorted(counts), np.uint64)
    for cells in (8, 256, 1 << 21):
        sketch = substrings.merged_sketch(frame, 6, cells, 2)
        repeated = substrings.estimated_repeated(every, sketch)
        assert all(repeated[i] for i, a in enumerate(every.tolist()) if counts[a] > 1)
    assert not all(repeated)


def test_passages_of_an_empty_table(spark):
    got = substrings.remove_repeated_passages(docs_of(spark, []))
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"] and got.count() == 0


def slow_negatives(rows, anchors, n_positives, k, low, high):
    clean = {
        (i, label, tuple(v))
        for i, label, v in rows
        if i is not None and label is not None and v is not None and None not in v
    }
    out = []
    for a, label, v in clean:
        if a not in anchors:
            continue
        others = sorted(
            (-sum(x * y for x, y in zip(v, w)), i, other)
            for i, other, w in clean
            if i != a
        )
        for minus, p, _ in [o for o in others if o[2] == label][:n_positives]:
            fit = [(s, i) for s, i, o in others if o != label and low * -minus <= 100 * -s <= high * -minus]
            out += [(a, p, r, i, -minus, -s) for r, (s, i) in enumerate(fit[:k], 1)]
    return sorted(out, key=repr)


def vectors(seed, n, dims, size):
    rng = random.Random(seed)
    rows = [(i, rng.randint(0, 3), [rng.randint(-size, size + 1) for _ in range(dims)]) for i in range(n)]
    rows += rows[:5] + [(None, 1, [1] * dims), (7001, None, [1] * dims), (7002, 1, None), (7003, 1, [1, None])]
    return rows + [(7004, 2, []), (7005, 2, [size]), (3, 0, [size] * dims), (20, 1, [0] * dims)]


@pytest.mark.parametrize("n,dims,size", [(300, 8, 50), (400, 3, 2), (60, 16, 300), (12, 4, 9)])
def test_negatives_equal_brute_force(spark, n, dims, size, monkeypatch):
    monkeypatch.setattr(covertree, "BLOCK", 32)
    monkeypatch.setattr(covertree, "CHUNK", 8)
    monkeypatch.setattr(covertree, "LEAF", 4)
    monkeypatch.setattr(covertree, "FAN", 3)
    rows = vectors(n, n, dims, size)
    frame = with_clashes(spark.createDataFrame(rows, VECTORS)).withColumn("id", F.lit("x"))
    got = covertree.mine_hard_negatives(frame, F.col("vec_id") % 10 == 0, 3, 4, 30, 90)
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    want = slow_negatives(rows, {r[0] for r in rows if r[0] is not None and r[0] % 10 == 0}, 3, 4, 30, 90)
    assert rows_of(got, *columns) == want and (want or n < 20)


def test_tree_covers_and_separates():
    rng = np.random.default_rng(3)
    points = rng.integers(-40, 40, (700, 5))
    tree = covertree.build_tree(np.arange(700), np.zeros(700, np.int64), points)
    assert sorted(tree.ids.tolist()) == list(range(700))
    real = tree.points.astype(float)
    sphere = np.column_stack([real, np.sqrt(np.maximum(tree.norm**2 - (real**2).sum(1), 0))])
    chord = 2 * tree.norm * np.sin(tree.angle / 2)
    for node in range(len(tree.start)):
        inside = sphere[tree.start[node] : tree.end[node]] - sphere[tree.centre[node]]
        assert np.sqrt((inside**2).sum(1)).max() <= chord[node] + 1e-6
        below = range(tree.child[node], tree.child[node] + tree.children[node])
        if below:
            assert tree.centre[below[0]] == tree.centre[node]
            assert tree.start[below[0]] == tree.start[node] and tree.end[below[-1]] == tree.end[node]
            centres = sphere[tree.centre[list(below)]]
            apart = np.sqrt(((centres[:, None] - centres) ** 2).sum(2)) + 1e9 * np.eye(len(centres))
            assert apart.min() + 1e-6 >= max(chord[i] for i in below)


def test_few_nodes_of_clustered_vectors_are_scored():
    rng = np.random.default_rng(1)
    points = (rng.normal(size=(40, 16)) * 100).repeat(100, axis=0) + rng.normal(size=(4000, 16)) * 3
    points = np.rint(points)
    tree = covertree.build_tree(np.arange(4000), np.zeros(4000, np.int64), points)

    class Counting(covertree.Best):
        scored = 0

        def add(self, scores, ids):
            Counting.scored += len(scores)
            super().add(scores, ids)

    everything = np.array([-np.inf]), np.array([np.inf]), np.array([-np.inf])
    best = Counting(*everything, 10)
    covertree.search(tree, tree.points.astype(float), points[5], 5, 0, True, best)
    want = np.sort(np.delete(points @ points[5], 5))[::-1][:10]
    assert best.scores[0].tolist() == want.tolist() and Counting.scored < 1000


def test_negatives_of_an_empty_table(spark):
    got = covertree.mine_hard_negatives(spark.createDataFrame([], VECTORS), F.lit(True))
    assert got.count() == 0


def test_scaled_floor(spark):
    rows = [([0.5, -0.001],), ([float("nan")],), ([float("inf")],), ([None],), (None,), ([],)]
    frame = spark.createDataFrame(rows, "v array<float>")
    got = [r[0] for r in frame.select(covertree.scaled_floor("v", 256)).collect()]
    assert got == [[128, -1], None, None, None, None, []]


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def slow_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow_ranking(rows, items, k):
    bags = [(i, Counter(slow_terms(t))) for i, t in rows]
    n_docs = sum(1 for _, bag in bags if bag)
    total = sum(bag.total() for _, bag in bags)
    df = Counter(term for _, bag in bags for term in bag)
    out = []
    for item, text in set(items):
        scored = []
        for i, bag in bags:
            m = 100 - 25 + (25 * bag.total() * n_docs) // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 12 * m))
                for t in slow_terms(text)
                if bag[t]
            )
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def sayings(seed, n):
    rng = random.Random(seed)
    words = [w for i in range(30) for w in [f"w{i}"] * (1 + 60 // (i + 1))] + ["É", "x_y", "it's", "Ö1"]
    rows = [(1, None), (2, ""), (3, "--"), (None, "w1 w2 W29"), (None, None)]
    for i in range(10, 10 + n):
        text = " ".join(rng.choices(words, k=rng.choice([1, 2, 3, 20, 20, 200])))
        rows.append((rng.choice([i, 7]), rng.choice([str.upper, str])(text)))
    rows += rows[-6:]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(8)]
    return rows, items + [items[0], (3, "w29 w28"), (None, "w27"), (20, None), (21, "!"), (22, "nowhere")]


@pytest.mark.parametrize("n,round_terms", [(120, 1 << 18), (500, 20)])
def test_ranking_equals_brute_force(spark, n, round_terms, monkeypatch):
    monkeypatch.setattr(lexical, "SHARD", 64)
    monkeypatch.setattr(lexical, "_FIRST", 4)
    rows, items = sayings(n, n)
    docs = with_clashes(docs_of(spark, rows)).withColumns({"rank": F.lit(1), "n": F.lit(2), "m": F.lit(3)})
    asked = with_clashes(spark.createDataFrame(items, "item_id bigint, text string"))
    got = lexical.rank_documents(docs, asked, 5, round_terms=round_terms)
    assert rows_of(got, "item_id", "rank", "doc_id", "score") == slow_ranking(rows, items, 5)


def test_strata_are_skipped(monkeypatch):
    """Far strata are not scored once k better documents are known."""
    m = np.repeat(np.arange(100, 200), 30)
    shard = lexical.Shard(m, np.ones(3000, np.int64), np.zeros(3000, np.int64), np.ones(3000, np.int64))
    monkeypatch.setattr(lexical, "_FIRST", 40)
    scored = []
    monkeypatch.setattr(lexical, "ranges", lambda a, b, f=lexical.ranges: scored.append(int(b.sum())) or f(a, b))
    docs, scores = shard.best(np.array([0]), np.array([500]), np.arange(3000), 20)
    assert docs.tolist() == list(range(20))
    assert set(scores.tolist()) == {500 * (10**9 // (1000 + 1200))} and max(scored) <= 100


def test_ranking_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    for docs, items in ((docs_of(spark, []), some), (docs_of(spark, [(1, "a")]), none)):
        assert lexical.rank_documents(docs, items).count() == 0


def test_ranking_of_a_long_text(spark):
    rows = [(1, "needle " + "hay " * 300_000), (2, "needle"), (3, "hay")]
    items = [(1, "needle hay")]
    got = lexical.rank_documents(docs_of(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))
    assert rows_of(got, "item_id", "rank", "doc_id", "score") == slow_ranking(rows, items, 20)
