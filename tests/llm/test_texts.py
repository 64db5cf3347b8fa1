"""Brute-force comparisons of the operators on whole texts."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stocklens.llm import decontam, jaccard, packing, spans, wordpiece
from stocklens.llm.common import window_hashes

JSON, RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def split(text, lower=False):
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


# --------------------------------------------------------------------- packing
def test_pieces_are_those_of_the_tokenizer_and_places_fit(docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(JSON)
    for capacity in (64, 2048):
        out = packing.pack_documents(docs, JSON, PATTERN, capacity).collect()
        expected = Counter()
        for doc_id, text, *_ in rows:
            ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
            first = len(ids) % capacity or capacity
            starts = [0] if len(ids) <= capacity else [0, *range(first, len(ids), capacity)]
            for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                expected[doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == expected
        in_sequence = defaultdict(list)
        for r in out:
            in_sequence[r.sequence_id].append((r.offset, r.length))
        for places in in_sequence.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(in_sequence) <= -(-sum(r.length for r in out) // capacity) + 2


def test_packing_of_nothing(no_docs):
    assert packing.pack_documents(no_docs, JSON, PATTERN).count() == 0


@given(st.lists(st.tuples(st.integers(1, 40), st.integers(1, 50)), max_size=20))
@settings(max_examples=60, deadline=None)
def test_a_plan_covers_the_histogram(pairs):
    histogram = np.zeros(41, np.int64)
    for length, n in pairs:
        histogram[length] += n
    covered = np.zeros(41, np.int64)
    for content, n in packing.plan(histogram, 40):
        assert n > 0 and sum(length * times for length, times in content) <= 40
        for length, times in content:
            covered[length] += times * n
    assert (covered == histogram).all()
    places = packing.slots(packing.plan(histogram, 40))
    assert len(set(zip(places["length"].tolist(), places["rank"].tolist(), strict=True))) == len(places["rank"])


@pytest.mark.parametrize("text", ["a b", " a  b ", "x\n y", "tab\t z  ", "<|endoftext|> a", "é à  b", "\x00 a b", "a", "", " ", "don't we're 12 3 !!", "a \n b \n\n c"])
def test_chunks_give_the_ids_of_whole_texts(text):
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.ChunkIds(JSON, PATTERN).encode([text])[0], "<u4").tolist() == ids


# ---------------------------------------------------------------- near duplicates
def brute_components(rows):
    sets = []
    for doc_id, text, *_ in rows:
        w = split(text, True)
        sets.append((doc_id, {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}))
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (a, x) in enumerate(sets):
        for j, (b, y) in enumerate(sets[:i]):
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            least[find(i)].append(doc_id)
    return Counter((d, len(s), min(least[find(i)]) if d is not None else None) for i, (d, s) in enumerate(sets))


def test_components_are_those_of_all_pairs(docs, rows):
    out = jaccard.jaccard_components(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components(rows)


def test_components_of_many_variants(spark):
    base = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(base[:i] + ["new"] + base[i:])) for i in range(40)] + [(100 + i, " ".join(base[i:] + [f"z{i}"] * i)) for i in range(12)]
    out = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components(rows)


@pytest.mark.parametrize("pivots", [0, 1, 3])
def test_components_of_different_texts_with_a_common_passage(spark, monkeypatch, pivots):
    random = np.random.default_rng(11)
    own = lambda n: [f"v{x}" for x in random.integers(0, 10**9, n)]
    passage, rows = own(40), []
    for i in range(40):  # little in common but the passage
        rows.append((i, " ".join(own(30) + passage + own(20))))
    for i in range(6):  # mostly the passage: linked with each other
        rows.append((50 + i, " ".join(passage + own(3))))
    for group in range(4):  # near copies of a text that holds the passage, chained: the first and the last are not alike
        words = own(60) + passage
        for i in range(9):
            words[i * 6 : i * 6 + 2] = own(2)
            rows.append((100 * group + 60 + i, " ".join(words)))
    docs = spark.createDataFrame([rows[i] for i in random.permutation(len(rows))], "doc_id bigint, text string").repartition(4)
    monkeypatch.setattr(jaccard, "PIVOTS", pivots)
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 5)
    out = jaccard.jaccard_components(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components(rows)


def test_a_pair_with_many_common_keys_is_made_once(spark):
    random = np.random.default_rng(5)
    nodes = [(i, 100, [int(x) for x in random.integers(0, 2, 2)]) for i in range(12)]  # sketches that let every pair pass
    common = [(int(k), i, i) for k in random.permutation(30) for i in range(12) if (i + k) % 4]
    alone = [(100 + i, i, i) for i in range(12)] + [(200, 12, 12), (200, 0, 0)]  # the least keys of 0 do not hold 200
    members = spark.createDataFrame(common + alone, "key bigint, node bigint, label bigint")
    info = spark.createDataFrame([*nodes, (12, 100, [1, 0])], "node bigint, n_shingles bigint, sketch array<bigint>")
    made = [(r.a, r.b) for r in jaccard._meetings(members, info, jaccard.THRESHOLD).collect()]
    assert sorted(made) == sorted([(a, b) for a in range(12) for b in range(a)] + [(12, 0)])
    assert {(r.a, r.b) for r in jaccard._across(members, info, jaccard.THRESHOLD).collect()} == set(made)


def test_no_components_of_nothing(no_docs):
    assert jaccard.jaccard_components(no_docs).count() == 0


@given(st.integers(1, 3000), st.integers(0, 2**30))
@settings(max_examples=80, deadline=None)
def test_similar_sets_share_a_block(n, seed):
    random = np.random.default_rng(seed)
    x = random.integers(0, 2**63, n, dtype=np.uint64)
    r = random.integers(0, n // 4 + 1)
    y = np.concatenate([x[: n - r // 2], random.integers(0, 2**63, r - r // 2, dtype=np.uint64)])
    x, y = np.unique(x), np.unique(y)
    common = len(np.intersect1d(x, y))
    if 100 * common >= 80 * (len(x) + len(y) - common):
        assert np.intersect1d(jaccard.block_keys(x), jaccard.block_keys(y)).size
        a, b = jaccard.parity_sketch(x), jaccard.parity_sketch(y)
        a, b = (s if len(s) == min(len(a), len(b)) else s[: len(s) // 2] ^ s[len(s) // 2 :] for s in (a, b))
        assert np.bitwise_count((a ^ b).view(np.uint64)).sum() <= len(x) + len(y) - 2 * common


# --------------------------------------------------------------- repeated spans
def brute_spans(rows, width):
    count = Counter(tuple(w[i : i + width]) for _, t, *_ in rows for w in [split(t)] for i in range(len(w) - width + 1))
    out = []
    for doc_id, text, *_ in rows:
        w = split(text)
        gone = set()
        for i in range(len(w) - width + 1):
            if count[tuple(w[i : i + width])] > 1:
                gone |= set(range(i, i + width))
        out.append((doc_id, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("width", [35, 12])
def test_repeated_spans_are_those_of_all_windows(docs, rows, width):
    out = spans.repeated_spans(docs, width).collect()
    expected = Counter((d, n, g, hashlib.sha256(kept).hexdigest()) for d, n, g, kept in brute_spans(rows, width))
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out) == expected


def test_text_form_keeps_rows_and_other_columns(docs, rows):
    out = spans.without_repeated_spans(docs).collect()
    expected = Counter((d, kept.decode() if g else row[1], row[3]) for row, (d, _, g, kept) in zip(rows, brute_spans(rows, 35), strict=True))
    assert Counter((r.doc_id, r.text, r.source) for r in out) == expected


def test_no_spans_of_nothing(no_docs):
    assert spans.repeated_spans(no_docs).count() == 0


@given(st.lists(st.integers(0, 2), max_size=60), st.lists(st.lists(st.integers(0, 2), max_size=30), max_size=3))
@settings(max_examples=80, deadline=None)
def test_matching_statistics(text, references):
    automaton = spans.SuffixAutomaton()
    for r in references:
        automaton.add(r)
    known = {tuple(r[i:j]) for r in references for i in range(len(r)) for j in range(i + 1, len(r) + 1)}
    expected = [max((n for n in range(1, i + 2) if tuple(text[i + 1 - n : i + 1]) in known), default=0) for i in range(len(text))]
    assert automaton.matching(text).tolist() == expected


def test_reference_spans_are_removed_over_shards(spark):
    w = [f"w{i}" for i in range(200)]
    reference = spark.createDataFrame([(" ".join(w[:60]),), (" ".join(w[100:150]),), (None,)], "text string")
    texts = [" ".join(["x", *w[5:50], "y", *w[100:140], "z"]), " ".join(w[10:30]), None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = dict(spans.remove_reference(docs, reference, 35, shard_words=40).collect())
    assert out == {0: "x y z", 1: texts[1], 2: None, 3: ""}


@given(st.lists(st.integers(0, 3), min_size=1, max_size=50), st.integers(1, 40))
@settings(max_examples=60, deadline=None)
def test_equal_windows_have_equal_hashes(values, width):
    h = window_hashes(np.array(values, np.uint64) + np.uint64(12345), width)
    windows = [tuple(values[i : i + width]) for i in range(len(values) - width + 1)]
    assert len(h) == len(windows) and len(set(windows)) == len(set(h.tolist()))
    assert len(set(zip(windows, h.tolist(), strict=True))) == len(set(windows))


# --------------------------------------------------------------- decontamination
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_contamination_is_that_of_all_windows(spark, docs, rows):
    long_text = rows[20][1]
    items = [(7, " ".join(long_text.split()[10:35])), (11, "Two-WORDS"), (12, "two words"), (13, None), (14, "..."), (None, long_text), (7, "one"), (15, "never seen before"), (16, "a a a a a a a a a a a a")]
    phrases = defaultdict(set)
    for item, text in items:
        w = WORD.findall((text or "").translate(FOLD))
        if item is not None and w:
            for i in range(max(1, len(w) - 9)):
                phrases[tuple(w[i : i + 10])].add(item)
    expected = Counter()
    for doc_id, text, *_ in rows:
        w = WORD.findall((text or "").translate(FOLD))
        hit, found = set(), set()
        for p, ids in phrases.items():
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i : i + len(p)]) == p:
                    hit |= set(range(i, i + len(p)))
                    found |= ids
        expected[doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)] += 1
    out = decontam.contamination(docs, spark.createDataFrame(items, "item_id bigint, text string"))
    assert Counter(tuple(r) for r in out.collect()) == expected


def test_contamination_of_and_by_nothing(spark, docs, no_docs, rows):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontam.contamination(no_docs, none).count() == 0
    assert decontam.contamination(docs, none).where("not contaminated").count() == len(rows)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x x b x x x x x a"), (2, "b c"), (3, None)], "doc_id bigint, text string")
    index = decontam.postings(docs, spark.createDataFrame([("a",), ("b",)], "term string"))
    assert sorted((r.pos, r.other) for r in decontam.proximity_matches(index, "a", "b", 3).collect()) == [(0, 3)]
    assert sorted((r.pos, r.other) for r in decontam.proximity_matches(index, "a", "b", 6).collect()) == [(0, 3), (9, 3)]


# ------------------------------------------------------------------ token counts
@given(st.sets(st.binary(min_size=1, max_size=4).map(lambda b: bytes(x % 3 for x in b))), st.binary(max_size=12).map(lambda b: bytes(x % 3 for x in b)))
@settings(max_examples=200, deadline=None)
def test_counts_are_those_of_greedy_matching(pieces, word):
    expected, rest = 0, word
    while rest and expected >= 0:
        n = next((k for k in range(len(rest), 0, -1) if rest[:k] in pieces), 0)
        expected, rest = (expected + 1, rest[n:]) if n else (-1, b"")
    assert wordpiece.LongestMatch(sorted(pieces)).count(word) == expected


def test_token_counts(docs, no_docs, rows):
    out = wordpiece.token_counts(docs, RANKS).collect()
    assert Counter((r.doc_id, r.n_words) for r in out) == Counter((d, len(split(t))) for d, t, *_ in rows)
    assert all(r.n_tokens >= r.n_words for r in out)
    assert wordpiece.token_counts(no_docs, RANKS).count() == 0
