"""Ranked lexical search, URL filter and hard negatives against brute force."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hitsessions.llm import hard_negatives as H
from hitsessions.llm import lexical_search as L
from hitsessions.llm import url_filter as U
from hitsessions.llm.rows import NULL_ID
from tests.llm.conftest import make


# ---------------------------------------------------------------- op11

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, k=20):
    """Rows (item, rank, id, score) by the formula, every document scored."""
    bags = [(NULL_ID if d is None else d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n, total = len(bags), sum(x[2] for x in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        q, scored = Counter(terms(text)), []
        for d, b, size in bags:
            m = 100 - 25 + (25 * size * n) // total
            score = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 12 * m))
                        for t, c in q.items() if t in b)
            if score > 0:
                scored.append((-score, d))
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def search(spark, docs, items, **options):
    items = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, d string, rank int")
    out = L.rank_documents(make(spark, docs), items, **options)
    return sorted(map(tuple, out.select("item_id", "rank", "d", "score").collect()), key=repr)


def test_search_edge_cases(spark, edge):
    rows, _ = edge
    items = [(1, "The of shared w1 w2 w2 w3"), (2, None), (3, ""), (4, "!!"), (None, "w5 straße 漢字"), (6, "w5 straße 漢字"),
             (6, "absent"), (7, "Documents IN many this line"), (8, " ".join(f"w{i}" for i in range(40)))]
    got = search(spark, rows, items)
    assert got == ranked(rows, items)
    assert {r[0] for r in got} == {1, None, 6, 7, 8}


@pytest.mark.parametrize("seed,block,pairs,group", [(1, 200, 96, 10**6), (2, 2000, 8, 10), (3, 200, 0, 25)])
def test_search_against_brute_force(spark, monkeypatch, seed, block, pairs, group):
    """Few words with a steep frequency: many blocks, pairs, ties and skipped blocks."""
    monkeypatch.setattr(L, "BLOCK_BYTES", block)
    monkeypatch.setattr(L, "GROUP_TERMS", group)
    rng = random.Random(seed)
    vocab = [f"t{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    body = lambda n: " ".join(rng.choices(vocab, weights, k=n))
    docs = [(rng.randint(0, 150), body(rng.randint(0, 30))) for _ in range(150)]
    docs += [(500 + i, docs[3][1]) for i in range(75)]  # a third are copies
    items = [(i, body(rng.randint(1, 25))) for i in range(20)]
    items += [(100 + i, items[0][1]) for i in range(10)]
    docs_df = make(spark, docs)
    index = L.build_index(docs_df, pair_terms=pairs)
    assert search(spark, docs, items, k=7, index=index) == ranked(docs, items, 7)
    index.remove()


def test_search_of_empty_tables(spark, empty):
    one = [(1, "some words")]
    assert search(spark, [], one) == [] == search(spark, [(1, None), (2, "--")], one)
    items = spark.createDataFrame([], "item_id string, text string")
    assert L.rank_documents(make(spark, one), items).collect() == []
    assert L.rank_documents(empty, items).collect() == []


def _block(rng, n_terms, n_docs):
    rows = [{"kind": "docs", "places": np.arange(n_docs).tobytes(), "counts": rng.integers(1, 60, n_docs).tobytes()}]
    for t in range(n_terms):
        at = np.flatnonzero(rng.random(n_docs) < rng.uniform(0.05, 0.9)).astype(np.int32)
        if len(at):
            rows.append({"kind": "term", "term": t, "places": at.tobytes(),
                         "counts": rng.integers(1, 6, len(at)).astype(np.int32).tobytes()})
    weights = {t: int(rng.integers(1, 3000)) for t in range(n_terms)}
    return L._Block(rows, weights, n_docs, 30 * n_docs), weights


@pytest.mark.parametrize("seed", range(5))
def test_pair_bounds_hold_and_skip_more(seed):
    """No candidate is lost, whatever the threshold; with pairs never more postings are looked at."""
    rng = np.random.default_rng(seed)
    b, weights = _block(rng, 12, 80)
    dense = np.zeros((12, 80), dtype=np.int64)
    for t, at in b.places.items():
        dense[t, at] = b.impacts[t]
    joint = np.array([[(dense[i] + dense[j]).max() for j in range(12)] for i in range(12)])
    bag = tuple((t, int(rng.integers(1, 4))) for t in range(12))
    plan = L.Plan(bag, weights, {t: t for t in range(10)})
    score = sum(q * dense[t] for t, q in bag)
    for least in [1, *np.sort(score)[score > 0][::4].tolist(), int(score.max()) + 1]:
        want = np.flatnonzero(score >= max(least, 1))
        looked = []
        for pairs in (joint, None):
            docs, found, seen = L.candidates(b, plan.units(b, pairs), int(least))
            assert docs.tolist() == want.tolist() and found.tolist() == score[want].tolist()
            looked.append(seen)
        assert looked[0] <= looked[1]


def test_a_pair_that_never_meets_rules_a_block_out():
    """Two terms with great maxima, in different documents: single maxima let the block through, the pair doesn't."""
    at = [np.arange(0, 40, 2, dtype=np.int32), np.arange(1, 40, 2, dtype=np.int32)]
    rows = [{"kind": "docs", "places": np.arange(40).tobytes(), "counts": np.full(40, 30).tobytes()}]
    rows += [{"kind": "term", "term": t, "places": at[t].tobytes(), "counts": np.full(20, 3, dtype=np.int32).tobytes()} for t in (0, 1)]
    b = L._Block(rows, {0: 1000, 1: 1000}, 40, 1200)
    plan = L.Plan(((0, 1), (1, 2)), {0: 1000, 1: 1000}, {0: 0, 1: 1})
    most = b.most[0]
    joint = np.full((2, 2), most)
    least = 2 * most + most // 2
    assert L.candidates(b, plan.units(b, joint), least)[2] == 0 < L.candidates(b, plan.units(b, None), least)[2]
    assert L.candidates(b, plan.units(b, joint), 2 * most)[0].tolist() == at[1].tolist()


# ---------------------------------------------------------------- op12

def judged(spark, urls, **options):
    schema = "page_id long, url string, host string, path string, verdict int, row string, u string, j string"
    pages = spark.createDataFrame([(n, u, "x", "y", 1, "r", "u", "j") for n, u in enumerate(urls)], schema)
    got = {r.row.page_id: r for r in U.filter_urls(pages, **options).collect()}
    assert len(got) == len(urls) and all(got[0].row[c] == v for c, v in (("host", "x"), ("verdict", 1)))
    return [(got[n].host, got[n].path, got[n].rule, got[n].verdict) for n in range(len(urls))]


def test_url_rules(spark):
    urls = ["https://a.example.net/en/1", "https://a.example.net/de/1", "http://EXAMPLE.com/de/x?y=1#z", "http://notexample.com/de/",
            "https://x.org/fr/xxx", "https://x.org/en/", "https://net/", "https://net", "https://x.net?u=/en/", "no scheme/net/",
            None, "", "://", "ftp://u@x.net:8/", "https://a.net/#://b.org/fr/", "https://example.net/EN/"]
    assert judged(spark, urls) == [
        ("a.example.net", "/en/1", "example.net/en/", "allow"), ("a.example.net", "/de/1", "net/", "block"),
        ("example.com", "/de/x", "example.com/de/", "block"), ("notexample.com", "/de/", None, "allow"),
        ("x.org", "/fr/xxx", "org/fr/", "allow"), ("x.org", "/en/", None, "allow"), ("net", "/", "net/", "block"),
        ("net", "", None, "allow"), ("x.net", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("u@x.net:8", "/", None, "allow"), ("a.net", "/", "net/", "block"),
        ("example.net", "/EN/", "net/", "block")]


def test_url_rule_ties_block(spark):
    rules = (("a.com", "/x", "allow"), ("a.com", "/x", "block"), ("b.a.com", "/", "allow"))
    got = judged(spark, ["http://a.com/x", "http://b.a.com/x", "http://c.a.com/x1"], rules=rules)
    assert [g[2:] for g in got] == [("a.com/x", "block"), ("b.a.com/", "allow"), ("a.com/x", "block")]
    with pytest.raises(ValueError):
        U.Rules([("a", "/", "maybe")])


def test_url_terms_against_regular_expressions(spark):
    rng = random.Random(5)
    vocab = U.Vocabulary(strict=("bad", "worse*"), soft=("ab", "b", "*cd", "a*"), soft_needed=2)
    urls = ["http://" + "".join(rng.choice(["a", "b", "cd", "bad", "WORSE", "-", ".", "/", "x", "é"]) for _ in range(rng.randint(0, 8)))
            for _ in range(300)]

    def hit(t, url):
        left, right = ("" if t[0] == "*" else "(?<![a-z0-9])"), ("" if t[-1] == "*" else "(?![a-z0-9])")
        return re.search(left + t.strip("*") + right, url.replace("WORSE", "worse")) is not None

    want = ["block" if any(hit(t, u) for t in vocab.strict) or sum(hit(t, u) for t in vocab.soft) >= 2 else "allow" for u in urls]
    assert [g[3] for g in judged(spark, urls, vocabulary=vocab, rules=())] == want
    assert set(want) == {"allow", "block"}
    nothing = U.Vocabulary(strict=(), soft=())
    assert {g[3] for g in judged(spark, urls, vocabulary=nothing, rules=())} == {"allow"}
    with pytest.raises(ValueError):
        U.Vocabulary(strict=("Bad",))


def test_url_filter_of_an_empty_table_and_a_long_url(spark):
    assert U.filter_urls(spark.createDataFrame([], "url string, path int")).collect() == []
    assert judged(spark, ["https://example.com/" + "ab/" * 100_000 + "viagra"])[0][3] == "block"


# ---------------------------------------------------------------- op13

def mined(rows, is_anchor, positives=5, negatives=5, low=80, high=100):
    """Rows (anchor, positive, rank, negative, scores), every pair scored in Python integers."""
    key = lambda r: (-r[0], NULL_ID if r[1] is None else r[1], r[2])
    use = [(d, y, x) for d, x, y in rows if y is not None and x is not None and len(x) and None not in x]
    out = []
    for i, (d, y, x) in enumerate(use):
        if d is None or not is_anchor(d):
            continue
        scored = [(sum(a * b for a, b in zip(x, x2)), d2, y2) for j, (d2, y2, x2) in enumerate(use) if j != i]
        good = sorted((s for s in scored if s[2] == y), key=key)[:positives]
        for p, pid, _ in good:
            bad = sorted((s for s in scored if s[2] != y and low * p <= 100 * s[0] <= high * p), key=key)[:negatives]
            out += [(d, pid, r + 1, b[1], p, b[0]) for r, b in enumerate(bad)]
    return sorted(out, key=repr)


def run(spark, rows, is_anchor, **options):
    schema = "vec_id long, embedding array<long>, label int, d string, x string, block int, key string"
    data = [(d, x, y, "d", "x", 1, "k") for d, x, y in rows]
    out = H.mine(spark.createDataFrame(data, schema).repartition(3), is_anchor, **options)
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("seed,block,group", [(1, 7, 8192), (2, 16, 3), (3, 1000, 5)])
def test_mining_against_brute_force(spark, monkeypatch, seed, block, group):
    """Many blocks and small groups of anchors; ties, repeated rows, nulls, a hot vector."""
    monkeypatch.setattr(H, "TILE", 11)
    rng = random.Random(seed)
    centre = [[rng.randint(-20, 40) for _ in range(6)] for _ in range(4)]
    rows = [(i, [c + rng.randint(-6, 6) for c in centre[i % 4]], rng.choice([i % 4, 0, 1])) for i in range(120)]
    rows += [(300 + i, rows[5][1], i % 3) for i in range(40)]          # a hot vector
    rows += [rows[10]] * 3 + [rows[11]] * 9 + [(20, rows[3][1], 2)]     # repeated rows, a repeated id
    rows += [(None, rows[8][1], 0), (400, None, 1), (410, [1, None, 2, 3, 4, 5], 1), (420, rows[9][1], None), (430, [], 1), (440, [9, 9], 0)]
    anchor = lambda d: d % 10 == 0
    got = run(spark, rows, anchor, block_rows=block, group=group)
    assert got and got == mined(rows, anchor)


def test_mining_of_great_and_of_no_numbers(spark):
    rng = random.Random(3)
    rows = [(i, [rng.randint(-2**29, 2**29) for _ in range(3)], i % 2) for i in range(40)]
    anchor = lambda d: d % 4 == 0
    assert run(spark, rows, anchor, block_rows=8) == mined(rows, anchor)
    assert run(spark, [], anchor) == [] == run(spark, [(0, [1, 2], 3)], anchor)
    assert run(spark, [(1, [1], 1), (2, [1], 2)], lambda d: d > 5) == []


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (5, 1)])
def test_hilbert_neighbours_touch(dims, bits):
    """Consecutive cells of the curve differ by one step in one dimension, and no cell is left out."""
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = H.hilbert_keys(cells, bits)
    assert len(set(keys)) == len(cells)
    walk = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_zone_maps_choose_few_blocks(spark):
    """Clusters far apart: a window needs the blocks of few of them, and no needed block is left out."""
    rng = np.random.default_rng(1)
    rows = [(i, (np.eye(8, dtype=int)[i % 8] * 500 + rng.integers(-9, 9, 8)).tolist(), i % 8 // 2) for i in range(800)]
    df = spark.createDataFrame([(d, x, y) for d, x, y in rows], "vec_id long, embedding array<long>, label int")
    blocks = H.lay_out(df, block_rows=50)
    some = blocks.rows.where("d % 100 = 0").collect()
    anchors = H._group(some, blocks)
    window = H.Windows(anchors, np.array([0]), [200_000], [H._NEVER], True, 5)
    zones = blocks.zones.collect()
    need = window.need([z.label for z in zones], np.array([z.lo for z in zones]), np.array([z.hi for z in zones]))
    chosen = {z.block for z, n in zip(zones, need[0]) if n}
    assert 0 < len(chosen) <= len({z.block for z in zones}) / 3
    x = np.array(some[0].x)
    hit = {r.block for r in blocks.rows.collect() if r.label == some[0].label and np.array(r.x) @ x >= 200_000}
    assert hit <= chosen
    blocks.remove()


def test_whole_numbers(spark):
    df = spark.createDataFrame([([0.5, -0.001],), ([float("nan")],), ([float("inf")],), ([None, 1.0],), (None,), ([],)],
                               "v array<float>")
    got = [r.x for r in df.select(H.whole_numbers(F.col("v")).alias("x")).collect()]
    assert got == [[128, -1], None, None, None, None, []]


def test_terms_are_the_contract_s():
    text = "Ab-c 9É_ß\x7fx[y`z{w|é漢\x00q"
    h, rows = L.terms_of(pa.array([text, None, ""]))
    want, _ = L.terms_of(pa.array(terms(text)))
    assert rows.tolist() == [0, len(terms(text))] + [len(terms(text))] * 2 and h.tolist() == want.tolist()
