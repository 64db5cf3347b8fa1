"""Fingerprints, source divergence and collocations against brute-force versions."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stocklens.llm import audit, bytewords, fingerprints, phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --------------------------------------------------------------------- fingerprints
def paragraphs(text):
    return Counter(p for p in re.split(r"\n|(?<=[.!?;:|])\s+", text) if p)


def likeness(a, b):
    a, b = set(paragraphs(a).items()), set(paragraphs(b).items())
    return 1.0 if not a and not b else 1 - len(a ^ b) / (len(a) + len(b))


def expected_versions(rows):
    """{(doc_id, text): (edited text, next text)} for rows with distinct, non-null ids."""
    order = sorted({(r[0], r[1] or "") for r in rows}, reverse=True)
    out = {}
    for i, (doc_id, text) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        out[doc_id, text] = (text[: len(text) - half] + after[:half], after)
    return out


SENTENCES = [f"{w} {v}." for w in ("Rain", "Snow", "Wind", "Hail") for v in ("falls", "stops", "comes again", "is over", "was heavy")]


def texts_of_sentences():
    rng = np.random.default_rng(5)
    texts = [None, "", "one", "é" * 31, "\n\n\n", "a.\nb.\na.\na.", "|".join("abc") + " | x", " ".join(f"S{i}." for i in range(900))]
    for i in range(40):
        drawn = rng.choice(SENTENCES, rng.integers(1, 30)).tolist()
        texts.append((" " if i % 3 else "\n").join([f"Number {i}.", *drawn]))
    return [(10 * i + 1, t, "en", "s", 0) for i, t in enumerate(texts)] + [(7, texts[10], "en", "s", 0), (5, texts[10], "fr", None, 1)]


def test_fingerprints_equal_brute_force(spark):
    rows = texts_of_sentences()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, fingerprint string, n_chars int").repartition(4)
    out = {r.doc_id: r for r in fingerprints.document_fingerprints(docs).collect()}
    versions = expected_versions(rows)
    assert len(out) == len(rows)
    for doc_id, text, *_ in rows:
        text = text or ""
        edited, after = versions[doc_id, text]
        r = out[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(likeness(text, edited)) and r.near_next == pytest.approx(likeness(text, after))
    assert out[7].fingerprint == out[5].fingerprint == out[101].fingerprint != out[111].fingerprint
    assert out[1].fingerprint == "" == out[11].fingerprint


def test_sketches_that_are_too_small_are_tried_again(spark, monkeypatch):
    rows = texts_of_sentences()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, a string, b string, c int").repartition(3)
    want = {(r.doc_id, r.near_edited, r.near_next, r.fingerprint) for r in fingerprints.document_fingerprints(docs).collect()}
    # The first attempt gets a quarter of the cells.
    monkeypatch.setattr(fingerprints, "SIZE", fingerprints.SIZE / 4)
    monkeypatch.setattr(fingerprints, "BROADCAST_KEYS", 0)
    assert {(r.doc_id, r.near_edited, r.near_next, r.fingerprint) for r in fingerprints.document_fingerprints(docs).collect()} == want


def test_fingerprints_of_nulls_repeats_and_nothing(spark, no_docs):
    docs = spark.createDataFrame([(None, "a. b.", 1), (None, None, 2), (3, "a. b.", 3), (3, "a. b.", 4), (3, "c.", 5)], "doc_id int, text string, k1 int")
    out = fingerprints.document_fingerprints(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.n_chars) for r in out if r.doc_id is not None) == [(False, 3, 2), (False, 3, 5), (False, 3, 5)]
    assert sum(r.doc_id is None for r in out) == 2
    assert fingerprints.document_fingerprints(no_docs).count() == 0
    assert fingerprints.document_fingerprints(docs.where("k1 = 5")).first().near_next == 1.0


def test_peeling_recovers_the_digests_of_each_side(spark):
    both = spark.createDataFrame([(1, 1, "a. b. c. c.", "b. d. c."), (1, 2, "x.", "x.")], "k1 bigint, k2 bigint, old string, new string")
    both = fingerprints.with_digests(fingerprints.with_digests(both, "old", "d_old"), "new", "d_new").cache()
    cells = fingerprints.sketches(both, ["d_old", "d_new"], 0)
    found = fingerprints.differences(fingerprints.peeled(fingerprints.subtracted(cells, [("d_old", "d_new")], []))).collect()
    row = both.where("k2 = 1").first()
    old, new = set(row.d_old), set(row.d_new)
    assert {(r.k2, r.digest, r.side) for r in found} == {(1, d, 1) for d in old - new} | {(1, d, -1) for d in new - old}


def test_fingerprints_need_no_python_worker(spark, docs):
    plan = fingerprints._attempt(docs, fingerprints.successors(docs), 0)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --------------------------------------------------------------------- words of bytes
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aZé. \n\x00\t_0", max_size=30)), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words_in_are_those_of_the_pattern(texts):
    words = bytewords.words_in([None if t is None else t.encode() for t in texts], bytewords.LETTERS)
    got = [(int(t), words.data[a:b].tobytes().decode()) for t, a, b in zip(words.text, words.start, words.end, strict=True)]
    assert got == [(i, w.translate(LOWER)) for i, t in enumerate(texts) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")]


@given(st.lists(st.tuples(st.integers(0, 2**64 - 1), st.integers(0, 3)), max_size=50))
@settings(max_examples=40, deadline=None)
def test_radix_order_is_a_stable_sort(rows):
    keys = [np.array([r[i] for r in rows], kind) for i, kind in ((0, np.uint64), (1, np.uint32))]
    assert audit.radix_order(keys).tolist() == sorted(range(len(rows)), key=lambda i: rows[i])


# --------------------------------------------------------------------- source divergence
def brute_divergence(rows, min_docs, top):
    groups = defaultdict(Counter)
    docs = defaultdict(Counter)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        groups[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in docs:
        kept = [w for w, n in docs[lang].items() if n >= min_docs]
        own = {s: c for (la, s), c in groups.items() if la == lang}
        whole = sum((Counter(c) for c in own.values()), Counter())

        def share(c, kept=kept):
            total = sum(c[w] for w in kept)
            return {w: 1 + 10**9 * (c[w] + 2) // (total + 2 * len(kept)) for w in kept}

        p, q = {s: share(c) for s, c in own.items()}, share(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in own:
            pairs = [(-sum(f(p[s][w], p[o][w]) for w in kept), o.encode(), o) for o in own if o != s]
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(sorted(pairs))]
            terms = [(-f(p[s][w], q[w]), w.encode(), w) for w in kept if own[s][w] and p[s][w] > q[w]]
            out += [(lang, s, "term", w, -v, i + 1) for i, (v, _, w) in enumerate(sorted(terms)[:top])]
    return sorted(out)


def audit_rows():
    rng = np.random.default_rng(2)
    words = ["a", "Be", "é", "straße", "eightlet", "ninelette", "sixteenletterss", "seventeenletterssx", "x" * 40, "X" * 39 + "y", "日本語の文章です" * 3, "zz"]
    rows = []
    for i in range(160):
        drawn = rng.choice(words, rng.integers(0, 25)).tolist()
        rows.append((i, "-1 ".join(drawn), ["en", "de", None, ""][i % 4], [None, "s1", "s2", "", "s3"][i % 5]))
    return rows + [(900, None, "en", "empty"), (901, "only here", "xx", "s1"), (902, "", "xx", "s2"), (903, "w" * 3000, "en", "s1"), rows[3], rows[3]]


@pytest.mark.parametrize("min_docs", [10, 1, 10**6])
def test_divergence_equals_brute_force(spark, monkeypatch, min_docs):
    rows = audit_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumns({}).repartition(5)
    out = audit.source_divergence(docs, min_docs, 3).collect()
    assert sorted(map(tuple, out)) == brute_divergence(rows, min_docs, 3)
    monkeypatch.setattr(audit, "BLOCK_CELLS", 7)
    monkeypatch.setattr(audit, "MATRIX_CELLS", 9)
    counts = audit.term_counts(docs, min_docs)
    pairs = audit.source_pairs(counts, audit.group_sums(counts), 7).collect()
    assert sorted((r.lang, r.source, r.item, r.value) for r in pairs) == [r[:2] + r[3:5] for r in brute_divergence(rows, min_docs, 3) if r[2] == "pair"]


def test_divergence_of_nothing_and_clashing_columns(spark, no_docs):
    assert audit.source_divergence(no_docs).count() == 0
    docs = spark.createDataFrame([(1, "a b", "en", "s", "x", 2)], "n bigint, text string, lang string, source string, term string, total int")
    assert audit.source_divergence(docs).count() == 0


def test_pair_sums_are_exact_for_the_largest_shares():
    p = np.array([[10**9 + 1, 1], [1, 10**9 + 1]], np.int64)
    assert audit.pair_sums(p)[0, 1] == 2 * ((10**9) ** 2 // (10**9 + 2))


# --------------------------------------------------------------------- collocations
def brute_collocations(rows, support, top):
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for k in (1, 2, 3):
                counts["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for w, c in f.items() if len(w) == 1)
        candidates = {w: a for w, a in f.items() if len(w) > 1 and a >= support}
        scored = []
        for w, a in candidates.items():
            longer = [b for v, b in candidates.items() if len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))]
            if any(100 * b >= 50 * a for b in longer):
                continue
            score, k = min((10**6 * a * a // (f[w[:k]] * f[w[k:]]), k) for k in range(1, len(w)))
            scored.append((-score, -a, " ".join(w).encode(), " ".join(w), f[w[:k]], f[w[k:]]))
        out += [(lang, i + 1, p, -a, left, right, n, -s) for i, (s, a, _, p, left, right) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def phrase_rows():
    rng = np.random.default_rng(8)
    words = ["new", "York", "city", "é", "a" * 70, "of", "the", "日本", "x\x00y", "a\xa0b"]
    rows = []
    for i in range(120):
        drawn = rng.choice(words, rng.integers(0, 30)).tolist()
        sep = rng.choice([" ", "\t", ", ", ". ", "\n", "  ", "\x0b"], len(drawn), p=[0.6, 0.1, 0.1, 0.05, 0.05, 0.05, 0.05]).tolist()
        rows.append((i, "".join(a + b for a, b in zip(drawn, sep, strict=True)), ["en", "de", None, "und"][i % 4]))
    return rows + [(500, None, "en"), (501, "", "fr"), (502, " new york " * 40, "fr"), (None, "the city of new york", "en"), rows[5], rows[5]]


@pytest.mark.parametrize("shards", [1, 4, 30])
def test_collocations_equal_brute_force(spark, shards):
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumns({}).repartition(6)
    out = phrases.collocations(docs, 10, 2000, shards).collect()
    assert sorted(map(tuple, out)) == brute_collocations(rows, 10, 2000)


def test_collocations_in_small_chunks_and_with_a_full_bitmap(spark, monkeypatch):
    rows = phrase_rows()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, lang string, n int, phrase string").repartition(2)
    monkeypatch.setattr(phrases, "MAX_BITS", 64)
    monkeypatch.setattr(phrases, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, phrases.collocations(docs, 5, 7).collect())) == brute_collocations(rows, 5, 7)


def test_collocations_of_nothing(spark, no_docs):
    assert phrases.collocations(no_docs).count() == 0
    none = spark.createDataFrame([(1, None, None)], "doc_id bigint, text string, lang string")
    assert phrases.collocations(none).count() == 0


def test_local_support_lets_no_frequent_phrase_escape():
    for total, shares in ((1000, (250, 250, 250, 250)), (7, (3, 3, 1)), (10**6, (999_999, 1))):
        least = [max(1, math.ceil(10 * own / total)) for own in shares]
        assert sum(n - 1 for n in least) < 10
