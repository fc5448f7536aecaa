"""Token alignment, source audit and exact search against brute force and on awkward rows."""

import hashlib
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as ent
from tests.conftest import SF001
from tests.llm.test_operators import DOCS, odd_rows
from voltframe.llm import divergence, jaccard, language, pii, quality, tokenalign, topk, urlfilter


@pytest.fixture(scope="module")
def pair():
    return tokenalign.Pair(*[open(f"{tokenalign.FOLDER}/{f}", "rb").read() for f in (tokenalign.FILE_A, tokenalign.FILE_B)])


# ------------------------------------------------------------------ 11 token alignment

def plain_groups(pair, text):
    """Groups by the sets of ends of both sides; [] where the bytes differ."""
    if not text:
        return []
    a, b, good = pair.tokens([text])[0]
    if not good:
        return []
    ends = [np.cumsum([len(names[i]) for i in ids]).tolist() for ids, names in ((a, pair.bytes_a), (b, pair.bytes_b))]
    cuts, i, j, out = sorted(set(ends[0]) & set(ends[1])), 0, 0, []
    for c in cuts:
        k, m = ends[0].index(c, i) + 1, ends[1].index(c, j) + 1
        out.append((a[i:k], b[j:m]))
        i, j = k, m
    return out


def brute_alignment(pair, texts):
    groups = [plain_groups(pair, t) for t in texts]
    links = [[(x, y) for a, b in g for x in a for y in b] for g in groups]
    count = Counter(p for one in links for p in set(one))
    highest = defaultdict(int)
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    rows = []
    for g, one in zip(groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        rows.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(one), sum(count[p] == highest[p[0]] for p in one), sum(count[p] for p in one), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return rows


TEXTS = ["", None, " ", "   ", "a", " a", "a ", "hello  world ", "\n\nx\ty", "x \n y", "tab\t after", "a▁b", "a ▁ b", "<|endoftext|> <s> </s> <unk> <0x41>", "é ﬁ ㎏ é", "日本語 テスト 🎉🎉", "a\x00b \x1c c", "no break space 　 wide",
         "don't we'll I'M 12,345.67 -- ... !!", "naïve café_au_lait http://a.b/c?d=e&f=g", "x" * 700, "ab " * 900, "日" * 300, "word​ zero width", "   lead and trail   ", "hello  world ", "hello  world "]


def odd_texts():
    rng = random.Random(5)
    bits = [" ", "  ", "\n", "\t", "a", "Zebra", "🙂", "ü", "12", "...", " ", "über", "'s", "'ll", "foo_bar", "日本", "\x85", "_", "-"]
    return TEXTS + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 80))) for _ in range(150)]


def of_align(spark, texts, **more):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r.doc_id: tuple(r)[1:] for r in tokenalign.align(docs, **more).collect()}


def test_alignment_against_brute_force(spark, pair):
    ent._prepare(spark)
    texts = odd_texts()
    got = of_align(spark, texts)
    assert [got[i] for i in range(len(texts))] == brute_alignment(pair, texts)
    assert got[texts.index("a▁b")] == (0, 0, 0, 0, 0, 0, "") == got[0] == got[1]


def test_alignment_of_the_given_table(spark, pair):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in ent.queries()["op11_tokenalign"](spark, SF001).collect()}
    assert [got[r.doc_id] for r in rows] == brute_alignment(pair, [r.text for r in rows])


def test_alignment_by_shuffle_join(spark, pair):
    texts = TEXTS + ["the cat sat on the mat " * 3, "the dog sat on the log"] * 4
    got = of_align(spark, texts, frequent=20)
    assert [got[i] for i in range(len(texts))] == brute_alignment(pair, texts)


def test_alignment_lanes_slices_and_batches(pair, monkeypatch):
    """Short lanes, slices, batches and memory change nothing; nor does reading texts whole."""
    texts = odd_texts()
    want = [(r["n_a"], r["n_groups"], r["n_links"], r["sha"], *[p.tolist() for p in r["pairs"]]) for r in tokenalign.Aligner(pair).align(texts)]
    for name, value in (("LANE", 3), ("SLICE", 40), ("BATCH", 200), ("REMEMBERED", 10)):
        monkeypatch.setattr(tokenalign, name, value)
    small = tokenalign.Aligner(pair)
    for at in range(0, len(texts), 50):
        assert [(r["n_a"], r["n_groups"], r["n_links"], r["sha"], *[p.tolist() for p in r["pairs"]]) for r in small.align(texts[at:at + 50])] == want[at:at + 50]
    monkeypatch.setattr(pair, "in_pieces", False)
    assert [(r["n_a"], r["n_groups"], r["n_links"], r["sha"], *[p.tolist() for p in r["pairs"]]) for r in tokenalign.Aligner(pair).align(texts)] == want


def test_pieces_join_to_their_text():
    for text in odd_texts():
        if text:
            assert " ".join(p for part in tokenalign.pieces(text) for p in part) == text


def test_alignment_odd_rows(spark):
    docs = spark.createDataFrame(odd_rows(), DOCS)
    out = tokenalign.align(docs).collect()
    assert len(out) == docs.count() and sum(r.n_a == 0 for r in out) == sum(not t[1] for t in odd_rows())
    assert len({r.groups_sha256 for r in out if r.doc_id == 9}) == 2
    assert all((r.groups_sha256 == "") == (r.n_a == 0) for r in out)


# ------------------------------------------------------------------ 12 source audit

def brute_audit(rows, least, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    n, df, groups = defaultdict(Counter), defaultdict(Counter), sorted({(lang, s) for lang, s, _ in rows})
    for lang, s, text in rows:
        w = divergence.terms(text)
        n[lang, s].update(w)
        df[lang].update(set(w))
    out = []
    for lang, s in groups:
        kept = sorted(t for t, c in df[lang].items() if c >= least)
        p = {x: {t: 1 + 10**9 * (n[lang, x][t] + 5) // (sum(n[lang, x][u] for u in kept) + 5 * len(kept)) for t in kept} for la, x in groups if la == lang}
        whole = Counter()
        for la, x in groups:
            if la == lang:
                whole.update(n[la, x])
        q = {t: 1 + 10**9 * (whole[t] + 5) // (sum(whole[u] for u in kept) + 5 * len(kept)) for t in kept}
        pairs = sorted([(-sum(abs(p[s][t] - p[x][t]) for t in kept), x.encode()) for x in p if x != s])
        terms = sorted([(q[t] - p[s][t], t.encode()) for t in kept if n[lang, s][t] and p[s][t] > q[t]])[:top]
        for part, found in (("pair", pairs), ("term", terms)):
            out += [(lang, s, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(found)]
    return sorted(out)


def plain_counts(rows):
    """(lang, source, term) -> occurrences and documents, text by text; a None term per group."""
    n, docs = Counter(), Counter()
    for lang, s, text in rows:
        n[lang, s, None] += 0
        docs[lang, s, None] += 0
        w = divergence.terms(text)
        n.update((lang, s, t) for t in w)
        docs.update((lang, s, t) for t in set(w))
    return n, docs


def batch_of(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)] if rows else [pa.array([], pa.string())] * 3, names=["lang", "source", "text"])


@pytest.mark.parametrize("held", [1, 200, 8 << 20])
def test_terms_counted_over_many_texts(monkeypatch, held):
    monkeypatch.setattr(divergence, "HELD", held)
    texts = ["", "a", "Aa aA", "a", "", "", "1 2 3", "b1b", "Z[@`{zZ\x7f\x00é", "é", "\u0080\U0001F642 x", " lead", "trail ", "ÉPÉE épée Épée", "it's", "x" * 300, "x", "-"]
    rng = random.Random(5)
    texts += ["".join(rng.choices("aAzZ@[`{09 \té\U00010000\n", k=rng.randint(0, 30))) for _ in range(300)]
    rows = [(rng.choice(["en", "de", ""]), rng.choice(["s1", "", "en", "\uffee"]), t) for t in texts]
    batches = [batch_of(rows[:1]), batch_of([]), batch_of(rows[1:30]), batch_of(rows).slice(30, 200), batch_of(rows[230:])]
    n, docs = Counter(), Counter()
    for out in divergence.count_batches(iter(batches)):
        for lang, s, t, c, d in zip(*[x.to_pylist() for x in out.columns]):
            n[lang, s, t] += c
            docs[lang, s, t] += d
    assert (dict(n), dict(docs)) == tuple(map(dict, plain_counts(rows)))
    assert list(divergence.count_batches(iter([batch_of([])]))) == []
    only = list(divergence.count_batches(iter([batch_of([("en", "s", ""), ("en", "s", "1")])])))
    assert [b.to_pylist() for b in only if held > 1] in ([], [[{"lang": "en", "source": "s", "term": None, "n": 0, "docs": 0}]])


def test_terms_counted_faster_than_text_by_text():
    rng = random.Random(6)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzäß", k=rng.randint(2, 12))) for _ in range(20_000)]
    rows = [(rng.choice(["en", "de"]), f"s{rng.randrange(20)}", " ".join(rng.choices(vocabulary, k=300)).title()) for _ in range(3_000)]
    batches = [batch_of(rows[i:i + 1000]) for i in range(0, len(rows), 1000)]

    def text_by_text():
        n, docs = defaultdict(Counter), defaultdict(Counter)
        for lang, s, text in rows:
            w = divergence.terms(text)
            n[lang, s].update(w)
            docs[lang, s].update(set(w))

    def cpu(work):
        start = time.process_time()
        work()
        return time.process_time() - start

    whole = min(cpu(lambda: list(divergence.count_batches(iter(batches)))) for _ in range(2))
    assert whole < 0.6 * cpu(text_by_text)


@pytest.mark.parametrize("size", [{}, {"range_size": 3, "cells": 4}, {"range_size": 7, "cells": 1000}])
def test_audit_against_brute_force(spark, size):
    ent._prepare(spark)
    rng = random.Random(11)
    words = "alpha beta Gamma delta épée ÉPÉE zeta eta-theta x9y \U0001F642 _ Ωmega".split()
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "é", "￮", "\U00010000", None]), " ".join(rng.choices(words, k=rng.randint(0, 9)))) for _ in range(150)]
    rows += [("en", "quiet", None), ("en", "quiet", "1 2 3"), ("fr", "alone", "alpha"), ("it", "a", "rare"), ("it", "b", None)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, source string, text string, term string, n int")
    got = divergence.audit(docs, least_docs=6, top=3, **size)
    assert sorted(map(tuple, got.collect())) == brute_audit(rows, 6, 3)


def test_audit_odd_rows(spark):
    docs = spark.createDataFrame(odd_rows(), DOCS)
    got = divergence.audit(docs, least_docs=2, top=50).collect()
    assert sorted(map(tuple, got)) == brute_audit([(r[2], r[3], r[1]) for r in odd_rows()], 2, 50)


# ------------------------------------------------------------------ 13 exact top-k

def brute_top(rows, every, k, scale=256):
    seen = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            seen[i] = min(seen.get(i, v), v)
    whole = lambda x: int(min(max(np.floor(np.float64(scale) * x), -np.finfo(float).max), np.finfo(float).max))
    w = {i: [whole(x) for x in v] for i, v in seen.items()}
    out = []
    for i in w:
        if i % every == 0:
            s = sorted((-min(topk.MOST, max(topk.LEAST, sum(a * b for a, b in zip(w[i], w[j])))), j) for j in w if j != i)[:k]
            out += [(i, r + 1, j, -v) for r, (v, j) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [False, True])
def test_top_k_against_brute_force(spark, monkeypatch, blocks):
    ent._prepare(spark)
    if blocks:
        monkeypatch.setattr(topk, "BLOCK", (16, 16))
        monkeypatch.setattr(topk, "QUERY_BLOCK", (4, 4))
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, rng.choice([0, 3, 3, 3, 5])) * rng.choice([0.001, 0.5, 1])]) for i in range(120)]
    rows += [(3, [9.0]), (3, [-9.0]), (200, None), (201, [1.0, None]), (205, [float("nan")]), (210, [1.0, float("inf")]), (None, [1.0]), (215, [0.0, 0.0]), (-5, [1.0, 1.0, 1.0]), (50, rows[50][1])]
    df = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "vec_id long, embedding array<double>, score double, rank int").repartition(4)
    got = topk.search(df.select("vec_id", "embedding"), F.col("vec_id") % 5 == 0)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 5, 5)


def test_top_k_of_huge_components(spark):
    rows = [(0, [1e300, 1.0]), (1, [1e300, -2.0]), (2, [-1e300, 3.0]), (3, [1e17, 1e17]), (4, [1e-300, 0.0]), (5, [1.7e308, 0.1]), (10, [0.0, 2.0**50])]
    got = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 5 == 0)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 5, 5)


def test_top_k_of_one_vector(spark):
    assert topk.search(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<double>"), F.col("vec_id") % 5 == 0).count() == 0


# ------------------------------------------------------------------ earlier operators: no caps, no prefixes, linear time

def test_words_of_the_thue_morse_kind_stay_apart(spark):
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rest = " one two three four five"
    docs = spark.createDataFrame([(1, word), (2, other), (3, word + rest), (4, other + rest), (5, word.upper())], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    one = jaccard.Shingler()
    assert one(word).tolist() != one(other).tolist() and one(word).tolist() == one(word.upper()).tolist()
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_shingle_hashes_of_random_words_differ():
    rng = random.Random(1)
    words = {"".join(rng.choice("abcdeé日") for _ in range(rng.randint(1, 40))) for _ in range(20_000)}
    one = jaccard.Shingler(1)
    assert len(one(" ".join(words))) == len(words)
    assert sorted(h for w in list(words)[:200] for h in one(w)) == sorted(one(" ".join(list(words)[:200])).tolist())


def test_shapes_are_read_whole_and_tokens_in_linear_time():
    assert quality.codes("a1" * 7 + "B")[1] != quality.codes("a1" * 7 + "-")[1]
    assert quality.codes("--Word!!")[0] == quality.codes("word")[0] and quality.codes("...") == quality.codes("...")
    start = time.time()
    quality.codes("x" + "." * 1_000_000 + "y")
    quality.codes("." * 1_000_000)
    pii.protect("key " + "a-" * 500_000)
    assert time.time() - start < 3


def test_secrets_keep_their_prefixes():
    m = pii._SECRET.search("my-api_key=abc1234567")
    assert m and m["body"] == "abc1234567"


def test_many_languages_and_few_ids(spark):
    ent._prepare(spark)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, " ".join((letters[k % 26] + letters[(k * 7 + 3) % 26] + letters[k // 26]) * 2 for _ in range(6)), f"lang{k:03d}") for k in range(250) for i in range(2 * k, 2 * k + 2)]
    rows += [(i % 3, f"same few ids {'xyz'[i % 3]} text {i}", "few") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert len(model["langs"]) == 251
    found = language.predict([r[1] for r in rows[:500]], model)[0]
    assert np.mean([f == r[2] for f, r in zip(found, rows)]) > 0.5
    small = language.fit(docs.where("lang = 'few'").unionByName(docs.where("lang = 'few'")), rows_per_lang=50)
    assert small["langs"] == ["few"]


def test_deep_paths_keep_their_branches(spark):
    deep = "/a/b/c/d/e/f/g/h/i/j/"
    rows = [("h", f"{deep}good/x{i}", 0.0, 1.0) for i in range(20)] + [("h", f"{deep}bad/12{i}", 1.0, 0.0) for i in range(20)]
    got = urlfilter.templates(spark.createDataFrame(rows, "host string, path string, bad double, good double")).collect()
    assert {tuple(r.template) for r in got if "bad" in r.path} == {tuple("abcdefghij") + ("bad", "*")}
    assert all(len(r.template) == 12 for r in got)
