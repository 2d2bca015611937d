"""Operators that compare documents, the classifier and the pipeline."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hitsessions.llm import crf, line_dedup, ngram_join, quality_classifier, sieve, substring_dedup, suffix_dedup
from hitsessions.llm.components import components
from hitsessions.llm.rows import NULL_ID, row_key, written
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm import brute
from tests.llm.conftest import make, ordered


def copies(seed, n=60, words=7, length=(0, 60)):
    """Documents of few words, many of them edited copies of others."""
    rng = random.Random(seed)
    vocab = [f"W{i}" for i in range(words)]
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.6:
            w = rng.choice(texts).split()
            for _ in range(rng.randint(0, 3)):
                if w and rng.random() < 0.5:
                    w[rng.randrange(len(w))] = rng.choice(vocab)
                elif w:
                    del w[rng.randrange(len(w))]
        else:
            w = [rng.choice(vocab) for _ in range(rng.randint(*length))]
        texts.append(" ".join(w))
    return [(rng.randint(0, 80), t) for t in texts]


@pytest.mark.parametrize("operator,window", [(substring_dedup.remove_repeats, 35), (suffix_dedup.remove_passages, 50)])
def test_repeats_edge_cases(edge, operator, window):
    rows, docs = edge
    got = [(r.n_words, r.n_removed, r.kept) for r in ordered(operator(docs, window=window), rows)]
    assert got == brute.repeats(rows, window)


@pytest.mark.parametrize("seed,window", [(1, 8), (2, 13)])
def test_repeats_against_brute_force(spark, seed, window):
    """Short windows over few words: many repeats that overlap and compete."""
    rows = copies(seed)
    want = brute.repeats(rows, window)
    docs = make(spark, rows)
    for out in (substring_dedup.remove_repeats(docs, window=window, bits=18),
                suffix_dedup.remove_passages(docs, window=window, seed=3, bits=18)):
        assert [(r.n_words, r.n_removed, r.kept) for r in ordered(out, rows)] == want


def test_results_do_not_depend_on_the_sieve(spark):
    """A sieve of a few bits lets everything through; the results stay."""
    rows = copies(5, n=40)
    docs = make(spark, rows)
    out = substring_dedup.remove_repeats(docs, window=9, bits=15)
    assert [(r.n_words, r.n_removed, r.kept) for r in ordered(out, rows)] == brute.repeats(rows, 9)


def test_levels_double_up_to_the_window():
    assert substring_dedup.levels(35) == [9, 18]
    assert substring_dedup.levels(100) == [25, 50]
    assert substring_dedup.levels(2) == [1]


def test_sieve_has_no_false_negatives(spark):
    keys = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 5000)
    built = sieve.build(spark.createDataFrame([(int(k),) for k in keys], "key long"), 20)
    assert sieve.hit(built.value, keys).all()
    other = np.random.default_rng(2).integers(-2**63, 2**63 - 1, 5000)
    assert sieve.hit(built.value, other).mean() < 0.02


def joined(found, rows):
    """(n_shingles, component) per row, by the row's own key."""
    got = {(r.d, r.t): (r.n_shingles, None if r.component == NULL_ID else r.component) for r in found.collect()}
    return got


@pytest.mark.parametrize("shingle,percent", [(4, 85), (5, 80)])
def test_ngram_join_edge_cases(edge, shingle, percent):
    rows, docs = edge
    found = ngram_join.members(docs, shingle=shingle, percent=percent)
    assert found.count() == len(rows)
    got = joined(found, rows)
    keys = {r.row["row"]: (r.d, r.t) for r in docs.select(
        F.struct("row").alias("row"), *ngram_join.row_key(docs, "doc_id", "text")).collect()}
    assert [got[keys[f"r{n}"]] for n in range(len(rows))] == brute.components(rows, shingle, percent)


@pytest.mark.parametrize("seed,shingle,percent", [(1, 1, 85), (2, 2, 80), (3, 3, 60)])
def test_ngram_join_against_brute_force(spark, seed, shingle, percent):
    rows = [(n, t) for n, (_, t) in enumerate(copies(seed, n=90, words=9, length=(0, 30)))]
    found = ngram_join.members(make(spark, rows), shingle=shingle, percent=percent, bits=18)
    got = {r.d: (r.n_shingles, r.component) for r in found.collect()}
    assert [got[n] for n in range(len(rows))] == brute.components(rows, shingle, percent)


@pytest.mark.parametrize("seed,shingle,percent", [(3, 2, 60), (4, 1, 80)])
def test_link_counts_against_brute_force(spark, seed, shingle, percent):
    """Every link between rows counts, copies and links inside a component too."""
    rows = copies(seed)
    sets = [brute.shingles(t, shingle) for _, t in rows]

    def links(i):
        return sum(j != i and len(a & b) * 100 >= percent * len(a | b) for j, b in enumerate(sets) if (a := sets[i]) and b)

    docs = make(spark, rows)
    got = {}
    for r in ngram_join.link_counts(docs, shingle=shingle, percent=percent, bits=18).collect():
        got[r.d, r.t] = (r.n_shingles, r.n_links)
    keys = {int(r.row[1:]): (r.d, r.t) for r in docs.select("row", *row_key(docs, "doc_id", "text")).collect()}
    assert [got[keys[n]] for n in range(len(rows))] == [(len(sets[n]), links(n)) for n in range(len(rows))]
    assert ngram_join.link_counts(docs.limit(0)).count() == 0


def test_joins_on_hot_keys_can_be_split(spark):
    """A signature, or a row, that a third of all rows share: both sides of its join come from exchanges of their own."""
    rows = [(i if i % 3 else 3, f"hot text of line {0 if i % 3 == 0 else i}\nshared by all of them") for i in range(90)]
    out = line_dedup.dedup_lines(make(spark, rows))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("dth") >= 2 and "hashpartitioning(dth" in plan
    few = spark.createDataFrame([(1, 2)], "sig long, hub long").groupBy("sig").agg(F.min("hub").alias("hub"))
    joined = ngram_join._by_signature(spark.createDataFrame([(1, 5)], "sig long, c long"), few.hint("merge"))
    assert joined._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(sig#") >= 2
    assert [tuple(r) for r in joined.select("sig", "c", "hub").collect()] == [(1, 5, 2)]


def test_similar_sets_share_a_signature():
    """The guarantee of the signatures, pair by pair, over sizes, seeds and edits."""
    rng = random.Random(4)
    for _ in range(150):
        percent = rng.choice([70, 80, 85, 95])
        n = rng.randint(1, 120)
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
        other = list(base)
        for _ in range(rng.randint(0, 1 + n // 8)):
            if other and rng.random() < 0.5:
                other.pop(rng.randrange(len(other)))
            else:
                other.append(f"n{rng.randint(0, 10**6)}")
        s = ngram_join.Sets(pa.array([" ".join(base), " ".join(other) or "x"]), 1)
        a, b = set(base), set(other or ["x"])
        if 100 * len(a & b) >= percent * len(a | b):
            row, sig = s.signatures(np.array([0, 1]), ngram_join.Bands(percent, int(s.size.max())))
            assert set(sig[row == 0].tolist()) & set(sig[row == 1].tolist())


def test_one_of_each(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (3, text + " more"), (3, text + " more"), (9, "something else entirely with its own words"),
            (9, "and another text under the same id as before"), (1, None), (1, None), (2, ""), (7, text.upper())]
    kept = sorted(((r.doc_id, r.text) for r in ngram_join.one_of_each(make(spark, rows)).collect()), key=str)
    assert kept == sorted([(3, text + " more"), *rows[3:8]], key=str)


def test_rows_whose_text_hashes_share_31_bits(spark):
    """Two unrelated texts under one id, equal in the low 31 bits of their hash, stay two rows."""
    texts = spark.range(300_000).select(F.concat_ws(" ", *[F.concat(F.lit(c), "id") for c in "abcdefgh"]).alias("x"))
    low = F.xxhash64("x").bitwiseAND(2**31 - 1)
    pair = texts.groupBy(low).agg(F.sort_array(F.collect_list("x")).alias("x")).where("size(x) > 1").first().x
    rows = [(None, pair[0]), (None, pair[1]), (4, f"first {pair[0]} last")]
    docs = make(spark, rows)
    want = brute.repeats(rows, 5)
    assert [r[1] for r in want] == [8, 0, 8]
    for out in (substring_dedup.remove_repeats(docs, window=5, bits=18),
                suffix_dedup.remove_passages(docs, window=5, seed=3, bits=18)):
        assert [(r.n_words, r.n_removed, r.kept) for r in ordered(out, rows)] == want
    kept = ngram_join.one_of_each(make(spark, rows[:2]), bits=18).collect()
    assert sorted(r.text for r in kept) == pair[:2]


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (4, 5), (20, 20), (5, 1), (11, 12)] + [(i, i + 1) for i in range(100, 140)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 10: 10, 11: 10, 12: 10, 20: 20, **{i: 100 for i in range(100, 141)}}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forward_backward_and_viterbi_by_enumeration():
    from itertools import product
    rng = np.random.default_rng(3)
    lengths = np.array([3, 0, 1, 4])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    score, move = rng.normal(size=(8, 3)), rng.normal(size=(3, 3))
    log_p = crf.forward_backward(score, move, starts, lengths)[0]
    best = crf.viterbi(score, move, starts, lengths)
    for s, n in zip(starts, lengths):
        paths = list(product(range(3), repeat=int(n)))
        value = np.array([sum(score[s + i, y] for i, y in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:]))
                          for p in paths])
        weight = np.exp(value - value.max()) / np.exp(value - value.max()).sum()
        for i in range(n):
            marginal = [sum(w for w, p in zip(weight, paths) if p[i] == y) for y in range(3)]
            assert np.allclose(np.exp(log_p[s + i]), marginal)
        assert tuple(best[s:s + n]) == paths[int(value.argmax())]


def test_classifier_held_out_accuracy(spark):
    from hitsessions.llm.queries import QUERIES
    out = QUERIES["op5_quality_classifier"](spark, SF_CHECK)
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97


def test_classifier_edge_cases(spark, edge, empty):
    rows, docs = edge
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0), (3, 0), (9, 0), (9, 1), (None, 1), (16, None)],
                                   "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels)
    got = ordered(quality_classifier.score(docs, model), rows)
    assert all(0 <= r.score <= 1 for r in got)
    assert quality_classifier.score(empty, model).count() == 0
    prior = quality_classifier.fit(docs, labels.where("quality = 1"))
    assert {round(r.score, 6) for r in ordered(quality_classifier.score(docs, prior), rows)} == {0.8}
    again = quality_classifier.fit(docs.repartition(5), labels)
    assert all(np.array_equal(a, b) for a, b in zip(model, again))


def test_classifier_sample_has_one_row_per_document(spark, monkeypatch):
    """An id that many rows share reaches the driver as one row."""
    rows = [(1, f"line {n} of a text\nand more") for n in range(300)] + [(2, "#### $$$$"), (3, "no label")]
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    collected, collect = [], type(labels).collect

    def counting(df):
        out = collect(df)
        collected.append(len(out))
        return out

    docs = make(spark, rows)
    monkeypatch.setattr(type(labels), "collect", counting)
    quality_classifier.fit(docs, labels)
    assert max(collected) == 2


def test_classifier_trains_on_all_lines(spark, monkeypatch):
    rows = [(1, "\n".join(f"line {n}" for n in range(150))), (2, "#### $$$$")]
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    monkeypatch.setattr(quality_classifier, "_model", lambda sample: sample)
    assert [r[2] for r in quality_classifier.fit(make(spark, rows), labels)] == [150, 1]


def test_classifier_sample_is_bounded_in_lines():
    x = np.arange(200_000, dtype=float)[:, None]
    some = quality_classifier._some_lines(x)[:, 0]
    assert 0 < len(some) <= quality_classifier.SAMPLE_LINES and (np.diff(some) > 0).all()
    assert some.min() < 40_000 and some.max() > 160_000  # from anywhere in the text
    assert len(quality_classifier._some_lines(x[:1000])) == 1000


def plain_measures(text):
    """The line measures in plain Python, one line at a time."""
    upper, digit = set(range(0x41, 0x5B)), set(range(0x30, 0x3A))
    letter = upper | set(range(0x61, 0x7B)) | set(range(0xC0, 0x100))
    symbol, shout, stop = set(b"#*$%&|<>{}[]\\^~=_/@"), set(b"!?"), set(b".!?:;\"'")
    lines = (text or "").encode().split(b"\n")
    words = [[w for w in re.split(rb"[\x20\x09-\x0D]+", x) if w] for x in lines]
    bags = [tuple(sorted(w)) for w in words]
    out = []
    for x, w, bag in zip(lines, words, bags):
        n, size = len(w), len(x)
        count = lambda s: sum(b in s for b in x)
        again = sum(a == b for a, b in zip(w, w[1:]))
        per = max(n, 1)
        out.append([1, n == 0, min(count(upper) / max(count(letter), 1), 1), min(count(symbol) / per, 3) / 3,
                    min(count(symbol) / per, 0.3) / 0.3, min(count(shout) / per, 2) / 2, count(digit) / max(size, 1),
                    count(letter) / max(size, 1), min(again / per, 1), min(again / per, 0.2) / 0.2, np.log1p(n) / 8,
                    min(size / per / 12, 2), size > 0 and x[-1] in stop, bags.count(bag) > 1 and n > 3])
    return np.array(out, dtype=float), np.array([len(x) for x in lines], dtype=float)


def plain_score(text, model):
    """Length-weighted mean marginal of "good", by sums over paths in plain floats."""
    weights, move = model
    x, size = plain_measures(text)
    zero = np.zeros(x.shape[1])
    near = [np.concatenate([x[i], x[i - 1] if i else zero, x[i + 1] if i + 1 < len(x) else zero]) for i in range(len(x))]
    local = np.exp([f @ weights for f in near])
    forward, backward = [local[0]], [np.ones(2)]
    for s in local[1:]:
        f = (forward[-1] @ np.exp(move)) * s
        forward.append(f / f.sum())
    for s in local[:0:-1]:
        b = np.exp(move) @ (s * backward[-1])
        backward.append(b / b.sum())
    p = np.array(forward) * np.array(backward[::-1])
    good = (p / p.sum(1, keepdims=True))[:, 1]
    return float((good * (size + 1)).sum() / (size + 1).sum())


def test_classifier_against_plain_python(spark, edge):
    """Measures and scores of the edge cases, and of texts with runs of junk, line by line."""
    rng = random.Random(8)
    bits = ["Some plain words here.", "### *** ###", "WIN!! NOW!!", "word word word word", "12 of 40", "", " \t", "é ß. 漢", "a | b | c"]
    texts = [t for _, t in edge[0]] + ["\n".join(rng.choices(bits, k=rng.randint(1, 12))) for _ in range(60)]
    x, size, first = quality_classifier.line_measures(pa.array(texts))
    for r, t in enumerate(texts):
        want, sizes = plain_measures(t)
        assert np.allclose(x[first[r]:first[r + 1]], want) and size[first[r]:first[r + 1]].tolist() == sizes.tolist()
    rows = list(enumerate(texts))
    docs = make(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(texts) - 60, len(texts))], "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels)
    got = ordered(quality_classifier.score(docs, model), rows)
    assert np.allclose([r.score for r in got], [plain_score(t, model) for t in texts], atol=1e-9)


def test_classifier_query_marks_a_null_id_as_not_held_out(spark):
    df = spark.createDataFrame([(None,), (4,), (7,)], "doc_id long")
    got = [r.h for r in df.select(quality_classifier.held_out(F.col("doc_id")).alias("h")).collect()]
    assert got[0] is False and all(g == (zlib.crc32(str(i).encode()) % 3 == 1) for g, i in zip(got[1:], (4, 7)))


def test_empty_tables(empty):
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert suffix_dedup.remove_passages(empty).count() == 0
    assert ngram_join.members(empty).count() == 0
    assert ngram_join.one_of_each(empty).count() == 0


def test_large_sets_are_told_apart_by_wide_parity():
    """Sets far larger than the short sketch: similar ones pass, unrelated ones don't, of unequal sizes too."""
    rng = np.random.default_rng(3)

    def text(words):
        return " ".join(f"w{w}" for w in words)

    base = rng.integers(0, 10**9, 6000)
    near = base.copy()
    near[rng.choice(6000, 60, replace=False)] = rng.integers(0, 10**9, 60)
    texts = [text(base), text(near), text(rng.integers(0, 10**9, 6000)), text(base[:5200]), text(rng.integers(0, 10**9, 2500))]
    s = ngram_join.Sets(pa.array(texts), 4)
    wide = [np.frombuffer(w, np.uint8) for w in s.wide_parity()]
    sets = [set(s.items[s.off[r]:s.off[r + 1]].tolist()) for r in range(len(texts))]

    def passes(i, j):
        size = min(len(wide[i]), len(wide[j]))
        differ = int(np.bitwise_count(ngram_join._folded(wide[i], size) ^ ngram_join._folded(wide[j], size)).sum())
        assert differ <= len(sets[i] ^ sets[j])  # never more than the sets differ in
        return 185 * differ <= 15 * (len(sets[i]) + len(sets[j]))

    assert passes(0, 1) and passes(0, 3) and not passes(0, 2) and not passes(2, 3)
    assert ngram_join.Sets(pa.array(["a b c d e", None]), 4).wide_parity() == [None, None]


def test_one_of_each_keeps_clean_rows_and_other_columns(spark):
    """Repeated rows, rows that share an id, near copies, empties: one row of each group, all others untouched."""
    rng = random.Random(6)
    body = lambda n: " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(n))
    hot, other = body(60), body(60)
    rows = [(5, hot)] * 40 + [(5, other), (6, hot + " tail"), (7, body(30)), (7, body(30)), (8, ""), (8, ""), (8, None), (None, hot)]
    docs = make(spark, rows)
    got = ngram_join.one_of_each(docs)
    assert got.columns == docs.columns
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in got.collect())
    assert kept == sorted([(True, 0, hot), (False, 5, other), (False, 7, rows[42][1]), (False, 7, rows[43][1]),
                           (False, 8, ""), (False, 8, ""), (False, 8, "")])


def test_pipeline_stages_on_empty_tables(spark, tmp_path):
    """Every stage gives an empty table with its columns."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0, name
        assert out.columns == docs.columns or name == corpus_pipeline.STAGES[-1][0]


def test_pipeline_stage_by_stage(spark):
    """Each stage against brute force on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    rows = {r.doc_id: r.text for r in docs.collect()}

    good = written(stages["quality classifier"](spark, docs, SF_SMALL), "good")
    assert good.columns == columns
    kept = {r.doc_id: r.text for r in good.collect()}
    assert 0 < len(kept) < len(rows) and all(rows[i] == t for i, t in kept.items())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    judged = [(i in kept) == (labels[i] == 1) for i in rows if i in labels]
    assert np.mean(judged) > 0.95

    lines = written(stages["line dedup"](spark, good, SF_SMALL), "lines")
    order = sorted(kept)
    want = dict(zip(order, (k for _, _, k in brute.line_dedup([(i, kept[i]) for i in order]))))
    got = {r.doc_id: (r.text, r.n_chars) for r in lines.collect()}
    assert lines.columns == columns and got == {i: (t, len(t)) for i, t in want.items()}

    # Some near copies, since line dedup leaves few here.
    more = lines.where(F.length("text") > 400).limit(5).select(
        (F.col("doc_id") + 100000).alias("doc_id"), F.concat("text", F.lit(" end")).alias("text"), *columns[2:])
    both = written(lines.unionByName(more), "both")
    rows = sorted((r.doc_id, r.text) for r in both.collect())
    near = written(stages["n-gram Jaccard join"](spark, both, SF_SMALL), "near")
    alone = [i for (i, t), (n, c) in zip(rows, brute.components(rows, 5, 80)) if c == i]
    assert near.columns == columns and sorted(r.doc_id for r in near.collect()) == alone

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    clean = written(stages["benchmark decontamination"](spark, near, SF_SMALL), "clean")
    rows = sorted((r.doc_id, r.text) for r in near.collect())
    hits = {i: h for (i, _), h in zip(rows, brute.benchmark_hits(rows, items, 10))}
    got = {r.doc_id: r.text for r in clean.collect()}
    assert sorted(got) == sorted(i for i, (n, hit, _) in hits.items() if hit == 0 or 100 * hit < 50 * n)
    for i, text in rows:
        if i in got and not hits[i][1]:
            assert got[i] == text

    out = stages["BPE encoding and decoding"](spark, clean, SF_SMALL).collect()
    assert sorted(r.doc_id for r in out) == sorted(got) and all(r.round_trip for r in out)
