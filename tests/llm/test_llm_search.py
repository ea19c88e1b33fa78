"""Near duplicates, top-k search, URL filter and the pipeline against brute force."""

import random

import numpy as np
import pytest
import xxhash
from helpers import SF, docs_of, rows_of, with_clashes

from pyspark.sql import functions as F

import corpus_pipeline
from cohortine.llm import langid, multiindex, ranking, simhash, urls
from cohortine.llm.base import read
from cohortine.llm.queries import SITE_RULES


def slow_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        low = low.replace(space, " ")
    words = [w for w in low.split(" ") if w]
    shingles = [words[i : i + 3] for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64(" ".join(s), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(codes, distance):
    """Index of the first member of each code's component, by union-find over all pairs."""
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(codes))]


def test_fingerprints():
    for text in ("", " \n", "One", "one TWO", "a b c d É é x\ty\x0bz", "w " * 50, "ß İ Σ x y"):
        assert simhash.fingerprint(text.encode()) == slow_fingerprint(text), text


def test_components_equal_brute_force(spark):
    docs = read(spark, SF, "documents").unionByName(docs_of(spark, [(9001, None), (9002, " "), (9003, "")]))
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    codes = [slow_fingerprint(r.text) for r in rows]
    want = [
        (r.doc_id, f"{c:016x}", rows[k].doc_id) for r, c, k in zip(rows, codes, components(codes, 3))
    ]
    got = simhash.near_duplicates(with_clashes(docs))
    assert rows_of(got, "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)


@pytest.mark.parametrize("distance", [0, 1, 3, 5])
def test_links_are_complete(spark, distance):
    rng = random.Random(distance)
    codes = []
    for _ in range(60):
        code = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            codes.append(code)
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                code ^= 1 << bit
    codes = sorted(set(codes))
    signed = [int(np.uint64(c).astype(np.int64)) for c in codes]
    table = spark.createDataFrame([(c,) for c in signed], "__fp bigint")
    got = {(r.a, r.b) for r in simhash.links(table, distance).collect()}
    want = {
        tuple(sorted((signed[i], signed[j])))
        for i in range(len(codes))
        for j in range(i)
        if (codes[i] ^ codes[j]).bit_count() <= distance
    }
    assert got == want
    labels = {r.v: r.label for r in simhash.contract(spark.createDataFrame(list(got) or [], "a bigint, b bigint")).collect()}
    roots = components(codes, distance)
    smallest = {}
    for c, k in zip(signed, roots):
        smallest[k] = min(c, smallest.get(k, c))
    assert all(labels.get(c, c) == smallest[k] for c, k in zip(signed, roots))


def test_thresholds():
    # Costs rise with the threshold; the sum must be met exactly at least cost.
    costs = [[0, 5, 50], [0, 1, 2], [0, 9, 9]]
    cost, chosen = simhash.allocate(costs, 0)
    options = [(a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) if a + b + c == 0]
    assert cost == min(sum(costs[i][t + 1] for i, t in enumerate(o)) for o in options)
    assert sum(chosen) == 0


def test_drop_near_duplicates(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(7, text), (3, text), (3, text), (None, text), (8, "other words here now"), (None, "lone one"), (None, "lone one"), (None, None), (12, "")]
    docs = with_clashes(docs_of(spark, rows))
    got = simhash.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert rows_of(got, "doc_id", "text") == sorted(
        [(3, text), (8, "other words here now"), (None, "lone one"), (12, "")], key=repr
    )
    assert simhash.drop_near_duplicates(docs_of(spark, [])).count() == 0


def test_drop_near_duplicates_with_repeated_ids(spark):
    """An id on rows with different texts loses none of them that has no copy."""
    texts = [" ".join(f"t{k}w{i}" for i in range(200)) for k in range(6)]
    rows = [(5, t) for t in texts] + [(5, texts[0]), (9, texts[1]), (2, texts[2]), (None, texts[3])]
    want = sorted([(2, texts[2])] + [(5, t) for k, t in enumerate(texts) if k != 2])
    assert rows_of(simhash.drop_near_duplicates(docs_of(spark, rows)), "doc_id", "text") == want


def brute_top_k(rows, queries, k):
    out = []
    for q, code in queries:
        near = sorted(((code ^ c) & (2**64 - 1)).bit_count() * 10**9 + i for i, c in set(rows))
        out += [(q, r, v % 10**9, v // 10**9) for r, v in enumerate(near[:k], 1)]
    return sorted(out)


def test_top_k_with_hot_codes(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(63) for _ in range(120)]
    codes = base + [base[0]] * 80 + [b ^ (1 << rng.randrange(60)) for b in base[:40]]
    rows = list(enumerate(codes))
    table = spark.createDataFrame(rows + rows[:5] + [(None, 3), (999, None)], "vec_id bigint, code bigint")
    queries = table.where("vec_id % 9 = 0 and code is not null")
    got = multiindex.top_k(with_clashes(table), with_clashes(queries), 5)
    want = brute_top_k(rows, [r for r in rows if r[0] % 9 == 0], 5)
    assert rows_of(got, "query_id", "rank", "neighbour_id", "distance") == sorted(want, key=repr)
    few = table.where("vec_id < 3")
    assert multiindex.top_k(few, few, 5).count() == 9
    assert multiindex.top_k(few, few.limit(0), 5).count() == 0
    assert multiindex.top_k(few.limit(0), few, 5).count() == 0


def test_sign_code(spark):
    vectors = [([1.0] + [-1.0] * 62 + [2.0],), ([0.0, float("nan"), 3.0],), ([],), (None,)]
    df = spark.createDataFrame(vectors, "v array<float>").select(multiindex.sign_code("v").alias("c"))
    want = [int(np.uint64((1 << 63) | 1).astype(np.int64)), 1 << 61, 0, 0]
    assert [r.c for r in df.collect()] == want


def test_urls(spark):
    cases = {
        None: ("", "", None), "no scheme": ("", "", None),
        "http://A.Example.COM/en/1?x#y": ("a.example.com", "/en/1", "example.com/en/"),
        "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/"),
        "x://b.www.example.com/en/z": ("b.www.example.com", "/en/z", "www.example.com/en/"),
        "http://notexample.com/en/1": ("notexample.com", "/en/1", "com/"),
        "http://com/": ("com", "/", "com/"), "http://example.com": ("example.com", "", None),
        "http://a.net/fr/?q": ("a.net", "/fr/", "net/fr/"), "http://a.net/de/1": ("a.net", "/de/1", None),
        "a://b://c/d": ("b:", "//c/d", None), "http://h?x/y": ("h", "", None), "http://": ("", "", None),
    }
    pages = spark.createDataFrame(
        [(i, u) for i, u in enumerate(cases)] + [(None, "http://a.net/es/"), (0, None)],
        "page_id bigint, url string",
    )
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    rows = urls.judge_urls(with_clashes(pages), labels, SITE_RULES).collect()
    assert len(rows) == len(cases) + 2
    verdicts = {f"{r.host}{r.path}": r.verdict for r in SITE_RULES}
    for r in rows:
        if r.page_id is not None:
            assert (r.host, r.path, r.rule) == list(cases.values())[r.page_id]
            assert r.verdict == verdicts.get(r.rule, "allow")
    assert urls.judge_urls(pages.limit(0), labels, SITE_RULES).count() == 0


def test_reputation(spark):
    def many(host, good, bad, unknown=0):
        return [(host, 1)] * good + [(host, 0)] * bad + [(host, None)] * unknown

    rows = many("a.fine.org", 90, 10) + many("b.fine.org", 45, 5) + many("x.spam.org", 5, 195)
    rows += many("y.spam.org", 0, 1, 3) + many("z.co.uk", 0, 0, 2) + many("new.fine.org", 0, 0, 1)
    rows += many("one.bad.org", 0, 1) + many("", 0, 0, 2)
    table = spark.createDataFrame(rows, "host string, good int")
    got = {r.host: r for r in urls.host_reputation(table).collect()}
    assert got["x.spam.org"].bad_bound > 0.8 and got["a.fine.org"].bad_bound < 0.2
    # A host leans on its domain where it has few pages of its own.
    assert got["y.spam.org"].good_rate < got["one.bad.org"].good_rate
    assert got["new.fine.org"].good_rate > got["one.bad.org"].good_rate
    assert got["one.bad.org"].bad_bound < 0.5
    assert got["x.spam.org"].labelled == 200 and got["z.co.uk"].labelled == 0


def test_pipeline_equals_single_steps(spark):
    """The stages keep what the models and a brute-force search say about every row."""
    docs = read(spark, SF, "documents")
    labels = read(spark, SF, "labels")
    rows = {r.doc_id: r for r in docs.collect()}
    quality = ranking.learn_quality(docs, labels)
    left = {i: r for i, r in rows.items() if ranking.score_texts(quality, [r.text.encode()])[0] >= 0.3}
    assert len(left) > 0.7 * len(rows)
    kept = docs.where(docs.doc_id.isin(*left))
    languages = langid.learn_languages(kept)
    left = {
        i: r for i, r in left.items()
        if (g := languages.predict(r.text.encode()))[0] != "und" and g[1] >= corpus_pipeline.MIN_CLOSENESS
    }
    ids = sorted(left)
    roots = components([slow_fingerprint(left[i].text) for i in ids], 3)
    want = sorted({ids[k] for k in roots})
    got = corpus_pipeline.run(spark, SF)
    assert sorted({r.doc_id for r in got.select("doc_id").collect()}) == want
    assert got.groupBy("doc_id").sum("length").count() == len(want)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "language ID", "SimHash near-dedup", "packing"]


def test_pipeline_stages_keep_columns_and_survive_odd_rows(spark):
    odd = docs_of(spark, [(1, None), (2, ""), (None, "the of and to"), (3, "x " * 20_000), (3, "x " * 20_000)])
    odd = with_clashes(odd)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns
        out.count()
        assert stage(spark, odd.limit(0), SF).count() == 0
    corpus_pipeline.STAGES[-1][1](spark, odd, SF).count()


def test_registered_domains(spark):
    want = {
        "a.com.cn": ("a.com.cn", "com.cn"),
        "x.y.b.com.cn": ("b.com.cn", "com.cn"),
        "shop.co.za": ("shop.co.za", "co.za"),
        "www.dept.gov.uk": ("dept.gov.uk", "gov.uk"),
        "one.github.io": ("one.github.io", "github.io"),
        "www.example.com": ("example.com", "com"),
        "co.example.de": ("example.de", "de"),
        "com.cn": ("com.cn", "com.cn"),
        "localhost": ("localhost", "localhost"),
        "": ("", ""),
    }
    hosts = spark.createDataFrame([(h,) for h in want], "host string")
    domain, suffix = urls.names_of(F.col("host"), urls.Reputation())
    got = {r.host: (r.d, r.s) for r in hosts.select("host", domain.alias("d"), suffix.alias("s")).collect()}
    assert got == want


def test_counted_outcomes_are_as_single_ones(spark):
    single = [("a.com", 1)] * 5 + [("a.com", 0)] * 3 + [("b.com", None)] * 4 + [("c.com", 0)] * 9
    counted = [("a.com", 1, 5), ("a.com", 0, 3), ("b.com", None, 4), ("c.com", 0, 9)]
    one = urls.host_reputation(spark.createDataFrame(single, "host string, good bigint"))
    two = urls.host_reputation(spark.createDataFrame(counted, "host string, good bigint, pages bigint"))
    assert rows_of(one, *one.columns) == rows_of(two, *one.columns)
