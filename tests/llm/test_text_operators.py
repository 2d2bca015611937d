"""Operators that map each document by itself, and line dedup, against brute force."""

import os
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hitsessions.llm import bpe, decontaminate, line_dedup, pii, quality_rules, textkit, token_counts
from hitsessions.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import make, ordered


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    want = con.sql(ORACLES[name]).project(", ".join(cols)).fetchall()
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == sorted(want, key=repr)


@pytest.fixture(scope="module")
def small(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def by_id(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, SF_SMALL).collect()}


def test_pii_query(spark, small):
    got = by_id(spark, "op4_pii")
    assert got.keys() == small.keys()
    for i, text in small.items():
        base, r = brute.base_pii(text), got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in base) for n in range(4)]
        listed = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == brute.sha(",".join(listed))
        assert [s for s in r.spans.split(",") if s and not s.startswith("secret")] == listed


def test_token_count_query(spark, small):
    got = by_id(spark, "op6_token_counts")
    start, inner = map(set, token_counts.byte_pieces(bpe.read_vocab(bpe.vocab_path())))
    assert got.keys() == small.keys()
    for i in sorted(small)[:60]:
        w = brute.words(small[i])
        if len(w) < 400:
            assert (got[i].n_words, got[i].n_tokens) == (len(w), sum(brute.greedy_pieces(b" " + x.encode(), start, inner) for x in w))


def test_bpe_query(spark, small):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(bpe.vocab_path())
    got = by_id(spark, "op7_bpe")
    assert got.keys() == small.keys()
    for i, text in small.items():
        ids = lib.encode(text or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].decoded_sha256) == (len(ids), brute.sha(back))
        assert got[i].ids_sha256 == textkit.sha256(np.array(ids, dtype="<u4").tobytes())


def test_batch_words_equal_the_pattern():
    texts = ["", " a  b\tc\x0bd ", None, "é 漢 x\x1fy", "last\n"]
    buf, off = textkit.text_bytes(pa.array(texts))
    starts, ends, rows = textkit.words(buf, off)
    got = [[bytes(buf[starts[i]:ends[i]]).decode() for i in range(rows[r], rows[r + 1])] for r in range(len(texts))]
    assert got == [brute.words(t) for t in texts]
    h = textkit.word_hashes(buf, starts, ends)
    flat = [w for r in got for w in r]
    assert len(set(h.tolist())) == len(set(flat))


@pytest.mark.parametrize("min_docs", [2, 4])
def test_line_dedup_edge_cases(edge, min_docs):
    rows, docs = edge
    got = [(r.n_lines, r.n_dropped, r.kept) for r in ordered(line_dedup.dedup_lines(docs, min_docs=min_docs), rows)]
    assert got == brute.line_dedup(rows, min_docs=min_docs)


def test_line_dedup_hot_line(spark):
    """A line that most documents hold: dropped everywhere but in the first."""
    rows = [(i, f"own line number {i}\na very common line") for i in range(300)]
    got = ordered(line_dedup.dedup_lines(make(spark, rows)), rows)
    assert [r.n_dropped for r in got] == [0] + [1] * 299


def test_quality_rules_edge_cases(edge):
    rows, docs = edge
    for (_, text), r in zip(rows, ordered(quality_rules.apply_rules(docs), rows)):
        w = brute.words(text)
        wins = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        covered = {i + o for i, k in enumerate(wins) if wins.count(k) > 1 for o in range(3)} if len(w) < 500 else None
        lines = [x for x in (text or "").split("\n") if brute.WORD.search(x)]
        assert (r.m.n_words, r.m.word_chars) == (len(w), sum(map(len, w)))
        assert r.m.n_dup_lines == len(lines) - len(set(lines))
        assert r.m.n_symbols == sum(c in "#*$%&|<>" for c in text or "")
        if covered is not None:
            assert r.m.n_repeat_words == len(covered)
            assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r.base_failed and r.kept)


def test_rules_follow_their_table(spark):
    docs = make(spark, [(1, "the cat and the dog of a house " * 2 + " ".join(f"word{i}" for i in range(60)))])
    kept = lambda rules: quality_rules.apply_rules(docs, rules=rules).first().kept
    assert kept(quality_rules.RULES)
    assert not kept((("stop", "stop_word_share", 0.9, None),))
    assert kept(())


def test_pii_edge_cases(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("a1.@2-@. 25+5() é") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += [None, "", "mail a.b@c.de, card 4539 1488 0343 6467, ip 10.0.0.300 and 10.0.0.30, call +1 (212) 555-0143",
              "1" * 5000, "a" * 5000 + "@", "x@y." + "z" * 3000, "4539148803436467 4539148803436467"]
    rows = list(enumerate(texts))
    for (_, text), r in zip(rows, ordered(pii.find_pii(make(spark, rows)), rows)):
        base = [(s.start, pii.KINDS.index(s.kind), s.stop) for s in r.spans if s.kind != "secret"]
        assert base == brute.base_pii(text)
        assert list(r.spans) == sorted(r.spans, key=lambda s: (s.start, pii.KINDS.index(s.kind)))


def test_pii_finds_secrets_and_leaves_prose(spark):
    secret = "3fdf5a35c7b8d733c0b5c7d364eda8ac88d929d1"
    rows = [(1, f'é configure token = "{secret}" please'), (2, "The token of respect is the key to a good word."),
            (3, "Internationalisation, Rechtsschutzversicherung: 1200 words."), (4, "TOTAL!! OF## THE&&& PARTS***")]
    got = ordered(pii.find_pii(make(spark, rows)), rows)
    assert [(s.kind, rows[0][1][s.start:s.stop]) for s in got[0].spans] == [("secret", secret)]
    assert [len(r.spans) for r in got[1:]] == [0, 0, 0]


#: Formats and sentences that the labelled table doesn't have, by kind of secret.
UNSEEN = {
    "hex": (["{h24}", "{h48}", "{h56}", "0x{h40}"], ["session secret = '*'", "sign with token * today", "deploy-key: *"]),
    "provider": (["xoxb-{d12}-{a18}", "AIza{a35}", "npm_{a36}", "SG.{a22}.{a43}", "dop_v1_{h64}", "rk_test_{a24}"],
                 ["slack_token=*", "use the key * from the vault", "my-auth: *", "export NPM_TOKEN=\"*\""]),
    "base64": (["{b24}==", "{b43}=", "{b60}"], ["signing_key = *", "<secret>*</secret>", "bearer * (old)"]),
    "password": (["{l5}{d2}!x", "{u1}{l5}{d3}", "{l3}-{l4}-{d4}", "{l2}{d1}{l2}{d1}{l2}{d2}"],
                 ["DB_PASS=*", "root password: *", "'passwd': '*'", "mot de passe, clé *", "Passwort = *", "la contraseña * sirve"]),
}
UNSEEN_CLEAN = ["The password of the day is friendship.", "checksum {h64} ok", "tag {h12} of the image", "ticket {d10} was closed",
                "see page {d3}, line {d2}", "token economies in {d4}", "A KEY ROLE!! FOR ALL!!", "la clave de todo", "ein Schlüssel zum Glück",
                "/usr/lib/python3.13/site-packages", "https://example.org/a/b?c=d&e={d5}", "version 2.{d2}.{d1} of the tool"]


def _filled(pattern, seed):
    return re.sub(r"\{([a-z])(\d+)\}", lambda m: pii._made(int(m[2]), pii.ALPHABETS[m[1]], f"{seed}.{m.start()}"), pattern)


@pytest.mark.parametrize("kind", sorted(UNSEEN))
def test_pii_recall_on_unseen_formats(kind):
    """Nine of ten secrets of formats and sentences outside the table are found, as whole values."""
    formats, sentences = UNSEEN[kind]
    assert not {c.replace("*", "") for c in sentences} & {c.replace("*", "") for c in pii.CONTEXTS}
    cases = [(s, _filled(f, f"{kind}{n}{m}{k}")) for n, f in enumerate(formats) for m, s in enumerate(sentences) for k in range(5)]
    texts = [s.replace("*", v) for s, v in cases]
    model, hit = pii.fit(), 0
    for (_, v), t, spans in zip(cases, texts, pii.spans_of(pa.array(texts), model)):
        hit += v in [t[a:b] for a, k, b in spans if k == 4]
    assert hit >= 0.9 * len(cases), (kind, hit, len(cases))


def test_pii_leaves_unseen_prose():
    texts = [_filled(c, f"clean{n}{k}") for n, c in enumerate(UNSEEN_CLEAN) for k in range(10)]
    wrong = [t for t, spans in zip(texts, pii.spans_of(pa.array(texts), pii.fit())) if any(k == 4 for _, k, _ in spans)]
    assert len(wrong) <= 0.02 * len(texts), wrong


def test_pii_decoding_in_stretches_is_exact():
    """Splitting at certain words gives the labels of one long Viterbi run."""
    from hitsessions.llm import crf
    rng = np.random.default_rng(5)
    weights, move = pii.fit()
    kinds = np.unique(rng.integers(0, 1 << pii.N_BITS, 60))
    shape = rng.choice(kinds, 800)
    rows = np.array([0, 0, 5, 300, 300, 800])
    full = crf.viterbi(crf.with_neighbours(pii.features(shape), rows[:-1], np.diff(rows)) @ weights, move,
                       rows[:-1], np.diff(rows))
    score = lambda y: [_path(shape, rows, y, weights, move)]
    assert np.allclose(score(full), score(pii.decode(shape, rows, (weights, move))))


def _path(shape, rows, y, weights, move):
    from hitsessions.llm import crf
    s = crf.with_neighbours(pii.features(shape), rows[:-1], np.diff(rows)) @ weights
    total = s[np.arange(len(y)), y].sum()
    return total + sum(move[y[i - 1], y[i]] for a, b in zip(rows, rows[1:]) for i in range(a + 1, b))


def test_token_counts(edge):
    rows, docs = edge
    pieces = token_counts.byte_pieces(bpe.read_vocab(bpe.vocab_path()))
    start, inner = map(set, pieces)
    for (_, text), r in zip(rows, ordered(token_counts.count_tokens(docs, bpe.vocab_path()), rows)):
        w = brute.words(text)
        assert r.n_words == len(w)
        if len(w) < 300 and max(map(len, w), default=0) < 400:
            assert r.n_tokens == sum(brute.greedy_pieces(b" " + x.encode(), start, inner) for x in w)


def test_longest_match_against_brute_force():
    rng = random.Random(1)
    some = lambda n, size: {bytes(rng.choice(b"ab") for _ in range(rng.randint(1, size))) for _ in range(n)}
    for _ in range(300):
        first, inner = some(rng.randint(1, 6), 4), some(rng.randint(0, 6), 5)
        automaton = token_counts.LongestMatch(first, inner)
        for _ in range(15):
            word = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 14)))
            assert automaton.count(word) == brute.greedy_pieces(word, first, inner)


def test_bpe_equals_the_library(edge):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(bpe.vocab_path())
    rows, docs = edge
    two = bpe.decode(bpe.encode(docs, bpe.vocab_path()), bpe.vocab_path())
    one = bpe.encode(docs, bpe.vocab_path(), decoded=True)
    for (_, text), r, q in zip(rows, ordered(two, rows), ordered(one, rows)):
        want = lib.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want
        assert r.decoded == lib.decode(want, skip_special_tokens=False)
        assert (r.ids, r.decoded) == (q.ids, q.decoded)


def test_bpe_words_of_any_length():
    """The scan, the heap and the library agree, with the end mark's text in between."""
    from tokenizers import Tokenizer
    lib, own = Tokenizer.from_file(bpe.vocab_path()), bpe.Encoder(bpe.read_vocab(bpe.vocab_path()))
    rng = random.Random(2)
    for n in (1, 5, 127, 128, 129, 130, 700):
        for alphabet in ("theaing", "ab", "=", "é1 ", "abc<|endoftext|> \n"):
            text = "".join(rng.choice(alphabet) for _ in range(n)) + "<|endoftext|>"
            assert np.frombuffer(own.encode(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids
    assert own.decode(np.array([99999, 50256], "<u4").tobytes()) == "<|endoftext|>"


ITEMS = [(1, "w1 w2, W3; w4 w5 w6 w7 w8 w9 w10 w11 w12"), (2, "w5 w6"), (3, None), (4, "  !! "), (None, "w20 w21 w22"),
         (5, "é É ß"), (2, "w30 w31 w32"), (6, "the of the of the of the of the of the")]


@pytest.mark.parametrize("shard_words", [200_000, 20])
def test_decontamination_edge_cases(spark, edge, shard_words):
    """One automaton, and several shards that meet per row."""
    rows, docs = edge
    rows = rows + [(30, "x w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 y"), (31, "w30-w31 w32 É é ß"), (31, "w30-w31 w32 É é ß")]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontaminate.find(make(spark, rows), items, shard_words=shard_words)
    out = out.withColumn("n_hit", decontaminate.n_hit(F.col("spans")))
    got = [(r.n_words, r.n_hit, list(r["items"])) for r in ordered(out, rows)]
    assert got == brute.benchmark_hits(rows, ITEMS, 10)


def test_decontamination_removes_spans(spark):
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(12)))], "item_id long, text string")
    passage = ", ".join(f"W{i}" for i in range(12))
    own = " ".join(f"own{i}" for i in range(40))
    rows = [(1, f"É {own} {passage}. rest"), (2, f"{passage}"), (3, own), (4, None), (5, f"{own} {passage} {own} {passage}!")]
    out = decontaminate.remove(decontaminate.find(make(spark, rows), items))
    got = {r.row.doc_id: r.clean for r in out.collect()}
    assert got == {1: f"É {own} . rest", 3: own, 4: "", 5: f"{own}  {own} !"}


def test_decontamination_removes_touching_passages_in_any_shards(spark):
    """Passages of two items side by side leave the text with the separator between them, however items are sharded."""
    words = [f"w{n}" for n in range(60)]
    passages = [" ".join(words[n:n + 10]) for n in range(0, 60, 10)]
    items = spark.createDataFrame([(f"i{n}", p) for n, p in enumerate(passages)], "item_id string, text string")
    body = " ".join(f"b{n}" for n in range(100))
    rows = [(n, f"{body} {a.upper()}, {b}. End") for n, a in enumerate(passages) for b in passages]
    docs = make(spark, rows)
    few, many = ([(r.row["row"], r.spans, r.bytes, r["items"]) for r in ordered(
        decontaminate.find(docs, items, shard_words=n), rows)] for n in (200_000, 20))
    assert few == many
    clean = decontaminate.remove(decontaminate.find(docs, items, shard_words=20))
    assert {r.clean for r in clean.collect()} == {f"{body} . End"}


def test_decontamination_long_and_repeated_items(spark, monkeypatch):
    """A long item and many copies of one fit small shards, with the results of one large shard."""
    words = [f"w{n}" for n in range(300)]
    items = spark.createDataFrame([("long", " ".join(words)), (None, "no one knows this")] + [
        (f"copy{n}", "some text that stands in fifty items") for n in range(50)], "item_id string, text string")
    rows = [(n, f"before {' '.join(words[n:n + k])} after") for n, k in zip(range(0, 290, 7), range(2, 60))]
    docs = make(spark, rows + [(500, "so some text that stands in fifty items is here"), (501, "no one knows this"),
                               (502, f"{words[-2]} {words[-1]}")])
    shards, build = [], decontaminate.build
    monkeypatch.setattr(decontaminate, "build", lambda s, w: shards.append(sum(len(t.split()) for _, t in s)) or build(s, w))
    one, many = (sorted((r.row.doc_id, r.spans, r.bytes, r["items"]) for r in decontaminate.find(
        docs, items, window=4, shard_words=n).collect()) for n in (200_000, 160))
    assert one == many and len(shards) > 2 and max(shards[1:]) <= 160
    by_id = {r[0]: r for r in one}
    assert by_id[500][1] == [1, 8] and len(by_id[500][3]) == 50
    assert by_id[501][1] == [0, 4] and by_id[501][3] == [] and by_id[502][1] == []
    assert all((r[3] == ["long"]) == (len(rows[n][1].split()) >= 6) for n, r in enumerate(one[:len(rows)]))


def test_decontamination_without_items(spark, edge):
    rows, docs = edge
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r.spans == [] and r["items"] == [] for r in ordered(decontaminate.find(docs, none), rows))


def test_suffix_automaton_against_brute_force():
    rng = random.Random(2)
    for _ in range(1500):
        window = rng.randint(1, 4)
        items = [(str(i), [rng.randint(0, 2) for _ in range(rng.randint(0, 7))]) for i in range(rng.randint(0, 5))]
        doc = [rng.randint(0, 2) for _ in range(rng.randint(0, 15))]
        hits, found = [], set()
        decontaminate.SuffixAutomaton(items, window).match(doc, 0, hits, found)
        want, names = set(), set()
        for k, x in items:
            for w in ([x] if 0 < len(x) < window else [x[i:i + window] for i in range(len(x) - window + 1)]):
                for s in range(len(doc) - len(w) + 1):
                    if w and doc[s:s + len(w)] == w:
                        want |= set(range(s, s + len(w)))
                        names.add(k)
        flat = decontaminate.merged(hits)
        assert {i for a, b in zip(flat[::2], flat[1::2]) for i in range(a, b)} == want and found == names


def test_empty_tables(spark, empty):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert line_dedup.dedup_lines(empty).count() == 0
    assert quality_rules.apply_rules(empty).count() == 0
    assert pii.find_pii(empty).count() == 0
    assert token_counts.count_tokens(empty, bpe.vocab_path()).count() == 0
    assert bpe.decode(bpe.encode(empty, bpe.vocab_path()), bpe.vocab_path()).count() == 0
    assert decontaminate.find(empty, items).count() == 0


def test_vocabulary_size_is_checked(tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_VOCAB_BYTES", 10)
    with pytest.raises(ValueError):
        bpe.read_vocab(bpe.vocab_path())
    assert os.path.getsize(bpe.vocab_path()) > 10
