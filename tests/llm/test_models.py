"""Learned operators, vectors, pages, and the pipeline."""

import html
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from stocklens.llm import lm, mtree, pages, quality, queries, toxicity
from stocklens.llm.common import table
from stocklens.llm.subwords import of_ranks

SF = "/root/testdata/sf0.001"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def crc(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m


# ----------------------------------------------------------------- classifiers
def test_quality_is_learned_and_scores_every_row(spark, docs, no_docs, rows):
    weights = quality.quality_weights(spark, SF)
    out = quality.score_quality(docs, weights).collect()
    assert Counter(r.doc_id for r in out) == Counter(d for d, *_ in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (r.doc_id is not None and crc(r.doc_id, 3) == 1) for r in out)
    assert quality.score_quality(no_docs, weights).count() == 0
    assert quality.accepted(docs, weights).columns == docs.columns
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    scored = [(r.predicted, labels[r.doc_id]) for r in queries.op6_quality_classifier(spark, SF).collect() if r.held_out and r.doc_id in labels]
    assert scored and np.mean([p == y for p, y in scored]) >= 0.9


def test_classifiers_without_labels(spark, docs, rows):
    none = spark.createDataFrame([(None, None, None), (1, None, None)], "doc_id bigint, quality int, toxic int")
    assert quality.score_quality(docs, quality.fit_quality(docs, none)).where("score = 0.5").count() == len(rows)
    assert toxicity.score_toxicity(docs, toxicity.fit_lexicon(docs, none)).where("score between 0 and 1").count() == len(rows)


def toxic_fixture():
    random.seed(5)
    words = ["".join(random.choices("bcdfgaeiou", k=5)) for _ in range(80)]
    rows, labels = [], []
    for i in range(200):
        text = random.choices(words, k=30)
        if i % 4 == 0:
            text.insert(random.randrange(30), random.choice(["idiot", "IDIOT", "vermin", "m0r0n", "moron"]))
        if i % 4 == 1:
            text.insert(random.randrange(30), "not vermin spray")
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 4 == 0)))
    return rows, labels


def test_toxicity_of_folded_words_and_exceptions(spark):
    rows, labels = toxic_fixture()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    lexicon = toxicity.fit_lexicon(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    more = [(1000, "you idi0t"), (1001, "an іdіоt here"), (1002, "not vermin spray"), (1003, None), (1004, ""), (1005, "quite clean " * 3000), (1006, "clean " * 3000 + "moron")]
    out = {r.doc_id: r for r in toxicity.score_toxicity(docs.union(spark.createDataFrame(more, docs.schema)), lexicon).collect()}
    truth = dict(labels)
    assert np.mean([out[i].predicted == y for i, y in truth.items() if crc(i, 5) == 0]) > 0.9
    assert [out[i].predicted for i in range(1000, 1007)] == [1, 1, 0, 0, 0, 0, 1]


def test_fold():
    assert toxicity.fold("1D10T id10t ｉdiot 2024 a1") == "1d10t idiot idiot 2024 a1" or toxicity.fold("id10t") == "idiot"
    assert toxicity.fold(None) == ""


# ------------------------------------------------------------------------- LM
def test_base_scores_are_exact_and_scores_are_probabilities(docs, no_docs, rows):
    out = lm.lm_scores(docs, RANKS, PATTERN).collect()
    texts = [(d, [*(t or "").encode().lower().split(), b""]) for d, t, *_ in rows]
    held = lambda d: d is not None and crc(d, 7) == 2
    c = Counter(w for d, ws in texts if not held(d) for w in ws)
    n, v = c.total(), len(c)
    expected = Counter((d, held(d), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for d, ws in texts)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == expected
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)
    assert lm.lm_scores(no_docs, RANKS, PATTERN).count() == 0


def test_mixture_and_attention_learn_from_every_word(spark):
    training = [i for i in range(20) if crc(i, 7) != 2][:8]
    rare = ["".join(chr(97 + (i * 7 + k * k * (i + 3)) % 26) for k in range(9)) for i in range(64)]
    # One rare word in each of the 64 chunks of the first text; no text is long enough that any part may be left out.
    rows = [(training[0], " ".join(f"{w}{' plain' * (lm.CHUNK - 1)}" for w in rare))] + [(i, f"Other text, of {i} words.") for i in training[1:]] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    model = lm.fit_model(docs, RANKS, PATTERN)
    pieces = of_ranks(RANKS, PATTERN)
    unseen = model.log_theta.max(1).min()
    assert all((model.log_theta[pieces.flat([f" {w}"])[0]].max(1) > unseen + 1).all() for w in rare)
    descent = lm.Descent(model.net)
    chunks = [(True, True, (t or "").lower().encode().split()) for _, t in docs.collect()]
    descent.over(*lm.examples(model, chunks), lm.PASS_RATE)
    passed = lm.net_pass(model, docs, lm.PASS_RATE)
    assert all(np.allclose(passed[n], p, atol=1e-5) for n, p in descent.net.items())
    assert any(not np.allclose(passed[n], p, atol=1e-5) for n, p in model.net.items())


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    n = 41
    net = {k: p.astype(np.float64) for k, p in lm.new_net().items()}
    x, begin = rng.normal(size=(n, lm.WIDTH)).astype(np.float32), np.repeat([0, 11, 30], [11, 19, 11])
    target, weight = rng.integers(0, lm.CLASSES, n), np.ones(n)
    loss = lambda p: -lm.forward(p, x, begin)[0][np.arange(n), target].mean()
    got = lm.gradients(net, lm.forward(net, x, begin)[1], target, weight)
    for name, g in got.items():
        at = np.unravel_index(int(np.abs(g).argmax()), g.shape)
        step = {k: p.copy() for k, p in net.items()}
        step[name][at] += 1e-3
        back = {k: p.copy() for k, p in net.items()}
        back[name][at] -= 1e-3
        assert abs((loss(step) - loss(back)) / 2e-3 - g[at]) < 0.02 * abs(g[at]) + 1e-4, name


def test_attention_sees_its_own_past_only():
    rng = np.random.default_rng(1)
    x, begin = rng.normal(size=(60, lm.WIDTH)).astype(np.float32), np.repeat([0, 25], [25, 35])
    net = lm.new_net()
    whole, _ = lm.forward(net, x, begin)
    alone, _ = lm.forward(net, x[25:], np.zeros(35, np.int64))
    y = x.copy()
    y[40:] += 1
    changed, _ = lm.forward(net, y, begin)
    np.testing.assert_allclose(changed[:40], whole[:40], rtol=1e-4, atol=1e-4)
    # Windows start elsewhere for the text alone: positions with its whole past in reach agree.
    np.testing.assert_allclose(alone[:7], whole[25:32], rtol=1e-4, atol=1e-4)


# ---------------------------------------------------------------------- top k
def brute_top(vectors, divisor, k):
    out = []
    clean = [(i, v) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    ints = [(i, np.floor(256 * np.array(v, np.float32).astype(float))) for i, v in clean]
    for a, (i, q) in enumerate(ints):
        if i % divisor == 0:
            best = sorted((-int(q @ x), j) for b, (j, x) in enumerate(ints) if a != b and len(x) == len(q))[:k]
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(best)]
    return Counter(out)


@pytest.mark.parametrize(("part_rows", "block_rows"), [(8192, 512), (150, 7)])
def test_top_k_is_that_of_all_rows(spark, part_rows, block_rows):
    rng = np.random.default_rng(2)
    vectors = [(i, rng.normal(size=6).round(1).tolist()) for i in range(600)]
    vectors += [(600 + i, vectors[3][1]) for i in range(200)] + [(5, vectors[5][1]), (1001, None), (None, [1.0] * 6), (1002, [None] * 6), (1004, [float("nan")] * 6), (1006, [float("inf")] * 6), (1050, [0.0] * 6), (1100, [2.0, 1.0])]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").selectExpr("*", "1 as rank", "'x' as score")
    out = mtree.top_k(df, part_rows=part_rows, block_rows=block_rows).collect()
    assert Counter(tuple(r) for r in out) == brute_top(vectors, 50, 5)


def test_top_k_of_few(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in mtree.top_k(df).collect()] == [(0, 1, 1, 256 * 512)]
    assert mtree.top_k(df.limit(0)).count() == 0


def test_substituted_edges_fold_to_lexicon_words_only():
    found = toxicity.Lexicon({"idiot$": 3.0, "scum$": 3.0, "trash$": 3.0, "stupi": 3.0}, frozenset(), np.zeros(4)).automaton()

    def folded(text):
        return toxicity.fold_edges(toxicity.fold(text), found)

    for text, word in (("1diot", "idiot"), ("1d1ot", "idiot"), ("5tupid", "stupid"), ("5cum", "scum"), ("$cum", "scum"), ("7rash", "trash"), ("idi07", "idiot"), ("1d10t", "idiot")):
        assert folded(f"You {text}, go") == f"you {word}, go"
        assert toxicity.total_weight(folded(f"({text})"), found, frozenset()) == 3.0
    clean = "5kg 10m 4th a1 3d $5 7up 1diots in 2024 at me@site.org 80s"
    assert folded(clean) == toxicity.fold(clean)


# ---------------------------------------------------------------------- pages
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>no</article>";</script></head><body>
<header class=top><h2>Site</h2></header><nav><ul><li>Home</li></ul></nav><div class="cookie-notice">Accept</div><!-- <article>x</article> -->
<article><h1>Head&amp;line</h1><p>One &lt;b&gt;  two<b>three</b> four<br>five<div class="ad"><div>Buy</div></div><p>six<aside>side</aside> seven
<form><input value="q">Search</form><section id="comments"><article>Reply</article></section></article>
<div class="sidebar">Links</div><footer>&copy; x</footer></body></html>"""


def test_marked_articles():
    article, _, _, found = pages.blocks_of(PAGE)
    assert found and " ".join(article) == "Head&line One <b> twothree four five six seven"
    assert pages.blocks_of(None) == ([], [], [], False)
    assert pages.blocks_of("<p>a < b &amp; c <i")[1] == ["a < b & c"]
    assert pages.blocks_of("<nav><li>x<article>kept</article>")[0] == ["kept"]


@pytest.mark.parametrize("page", [
    '<main class="has-sidebar"><p>Text</p></main>', '<article class="post comments-open"><p>Text</p></article>', '<main class="sidebar"><p>Text</p></main>',
    '<div class="layout no-sidebar"><article>Text</article></div>', '<div id="content-with-menu"><div role=main>Text</div></div>',
    '<div class="widget"><section class="menu"><article>Text<div class="comments"><article>Reply</article></div></article></section></div>',
])
def test_class_words_never_drop_the_main_text(page):
    assert pages.blocks_of(page)[0] == ["Text"] and pages.blocks_of(page)[3]


def test_class_tokens_that_name_a_block_drop_it():
    page = "<main>Text{}</main>"
    for names in ("sidebar", "x comments", "comment-list", "sidebarWidget", "site-footer", "cookie-notice", "ad-slot-3"):
        assert pages.blocks_of(page.format(f'<div class="{names}">Lost</div>'))[0] == ["Text"]
    for names in ("no-sidebar", "with-menu", "comments-open", "has-ads"):
        assert pages.blocks_of(page.format(f'<div class="{names}">Kept</div>'))[0] == ["Text", "Kept"]


def test_suffix_array():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 30, 200):
        tokens = rng.integers(0, 3, n)
        order, common = pages.suffix_array(tokens)
        suffixes = sorted(range(n), key=lambda i: tokens[i:].tolist())
        assert order.tolist() == suffixes
        for x, (a, b) in enumerate(zip(suffixes, suffixes[1:], strict=False)):
            same = next((k for k in range(n) if max(a, b) + k >= n or tokens[a + k] != tokens[b + k]), 0)
            assert common[x + 1] == same


def test_unmarked_pages_lose_what_recurs_on_their_host(spark):
    menu, foot = "Home News Sport Weather About us and more", "All rights reserved by the owners of this site"
    rows = [(i, f"http://H.example.org:80/{i}", f"<div>{menu}</div><div>Story{i} {' '.join(f'w{i}x{j}' for j in range(20))}</div><p>{foot}</p>", "x") for i in range(12)]
    rows += [(50, None, None, "x"), (51, "http://h.example.org/", "", "x"), (52, "http://other.org", f"<p>{menu}</p>", "x"), (53, "http://h.example.org/z", PAGE, "x"), (None, None, "<p>loose</p>", "x")]
    out = pages.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()
    got = {r.page_id: r.text for r in out}
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    assert all(got[i] == f"Story{i} {' '.join(f'w{i}x{j}' for j in range(20))}" for i in range(12))
    assert (got[50], got[51], got[52], got[None]) == ("", "", menu, "loose")
    assert got[53] == "Head&line One <b> twothree four five six seven"
    assert pages.main_texts(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_text_is_decoded(spark):
    page = f"<main><p>{html.escape('a < b & c')}&nbsp;d</p></main>"
    out = pages.main_texts(spark.createDataFrame([(1, "http://a.b/", page)], "page_id bigint, url string, html string")).first()
    assert (out.text, out.n_chars) == ("a < b & c d", 11)


@pytest.mark.parametrize("shard_pages", [1_000, 5])
def test_marked_articles_lose_what_recurs_on_their_host(spark, shard_pages):
    notice = "Our house rules apply to all readers of this paper"
    own = [" ".join(f"w{i}x{j}" for j in range(20)) for i in range(30)]
    rows = [(i, f"http://h.org/{i}", f"<article><div class=x>{notice}</div><p>{own[i]}</p></article>") for i in range(30)]
    copied = " ".join(f"c{j}" for j in range(30))
    rows += [(100 + i, f"http://h.org/c{i}", f"<p>Menu{i}</p><article>{copied}</article>") for i in range(4)]
    rows += [(200 + i, f"http://h.org/n{i}", f"<article>{copied} Edition{i}</article>") for i in range(4)]
    got = {r.page_id: r.text for r in pages.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string"), shard_pages).collect()}
    assert all(got[i] == own[i] for i in range(30))
    assert all(got[100 + i] == copied and got[200 + i] == f"{copied} Edition{i}" for i in range(4))


def test_runs_are_counted_over_the_whole_host(spark):
    foot = "All rights reserved by the owners of this site"
    own = [" ".join(f"w{i}x{j}" for j in range(9)) for i in range(400)]
    few = (7, 150, 333)  # 3 of 400 pages: under 2 % of a shard, and in different shards
    rows = [(i, f"http://h.org/{i}", f"<p>{own[i]}</p>" + (f"<p>{foot}</p>" if i in few else "")) for i in range(400)]
    rows += [(500 + i, f"http://h.org/{i}", f"<p>Two{i} pages only do not make a run</p>") for i in range(2)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for shard_pages in (1_000, 40):
        got = {r.page_id: r.text for r in pages.main_texts(df, shard_pages).collect()}
        assert all(got[i] == own[i] for i in range(400))
        assert got[501] == "Two1 pages only do not make a run"


@pytest.mark.parametrize("shard_pages", [1_000, 3])
def test_repeated_rows_are_one_page(spark, shard_pages):
    first, second = "One page that stands here three times over", "A page without an id that stands here too"
    versions = "One id with three versions of the same long text"
    rows = [(1, "http://h.org/1", f"<p>{first}</p>")] * 5 + [(None, "http://h.org/2", f"<p>{second}</p>")] * 5
    rows += [(2, "http://h.org/3", f"<p>{versions} {i}</p>") for i in range(5)] + [(2**60 + 1, "http://h.org/4", "<p>big</p>")]
    out = pages.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string"), shard_pages).collect()
    assert sorted(r.text for r in out if r.page_id == 1) == [first] * 5
    assert sorted(r.text for r in out if r.page_id is None) == [second] * 5
    assert sorted(r.text for r in out if r.page_id == 2) == [f"{versions} {i}" for i in range(5)]
    assert [r.text for r in out if r.page_id == 2**60 + 1] == ["big"]


# ------------------------------------------------------------------- pipeline
def test_stages_keep_the_columns_and_handle_odd_rows(spark, docs, no_docs):
    for rows in (docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, rows, SF)
            assert made.columns == corpus_pipeline.COLUMNS if name != "best_fit_packing" else made.count() >= 0


def test_near_duplicates_are_told_apart_by_id_and_text(spark):
    a, b = " ".join(f"a{i}" for i in range(20)), " ".join(f"b{i}" for i in range(20))
    rows = [(3, a), (5, b), (5, a), (5, b), (7, ""), (7, None), (7, b + " end"), (9, "alone"), (None, a), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()), key=str)
    assert [r for r in kept if r[0] is not None and r[0] != 7] == [(3, a), (5, b), (9, "alone")]
    assert len([r for r in kept if r[0] == 7]) == 1 and not [r for r in kept if r[0] == 7][0][1]
    assert len([r for r in kept if r[0] is None]) == 2


def test_pages_lose_whole_blocks_of_their_host_only(spark):
    """The whole query on 200 pages over three hosts against the rule, by brute force."""
    rng = np.random.default_rng(5)
    common = ["the", "of", "and", "to", "in"]
    notices = [" ".join([f"notice{i}", *rng.choice(common, 7)]) for i in range(4)]
    rows, expected = [], {}
    for i in range(200):
        host, marked = f"h{i % 3}.org", i % 2 == 0
        prose = [" ".join(rng.choice([*common, *(f"w{i}x{j}" for j in range(6))], rng.integers(3, 40))) + f" end{i}x{k}" for k in range(4)]
        blocks = [*prose[:2], notices[i % 4], *prose[2:], "Read more"] if i < 150 else prose
        body = "".join(f"<p>{b}</p>" for b in blocks)
        rows.append((i, f"http://{host}/{i}", f"<nav>Menu</nav><main>{body}</main>" if marked else f"<nav>Menu</nav>{body}"))
        gone = {notices[i % 4]} | (set() if marked else {"Read more"})
        expected[i] = " ".join(b for b in blocks if b not in gone)
    for shard_texts in (5_000, 2):
        out = pages.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4), shard_texts).collect()
        assert {r.page_id: r.text for r in out} == expected


def _by_rule(rows):
    """Main texts by the rule: every run of every judged block is counted."""
    run, judged, runs, wholes = pages.RUN_TOKENS, {}, {}, {}
    windows = lambda b: [tuple(b.split(" ")[i : i + run]) for i in range(b.count(" ") + 2 - run)]
    for page, url, source in rows:
        article, loose, _, found = pages.blocks_of(source)
        judged[page] = (url.split("/")[2], found, article if found else loose)
        for block in judged[page][2]:
            if not found or windows(block):  # few words count on unmarked pages alone
                wholes.setdefault((judged[page][0], block), set()).add(page)
            for window in windows(block):
                runs.setdefault((judged[page][0], window), set()).add(page)

    def goes(host, marked, block):
        here = windows(block)
        if len(wholes.get((host, block), ())) >= pages.RUN_PAGES:
            return bool(here) or not marked
        often = [len(runs[host, w]) >= pages.RUN_PAGES for w in here]
        n = block.count(" ") + 1
        return not marked and bool(here) and all(any(often[max(0, t - run + 1) : t + 1]) for t in range(n))

    return {page: " ".join(b for b in blocks if not goes(host, marked, b)) for page, (host, marked, blocks) in judged.items()}


@pytest.mark.parametrize("in_article", [False, True])
def test_runs_count_wherever_they_stand_in_a_block(spark, in_article):
    """A block made of runs that elsewhere only stand inside of other blocks goes as well."""
    parts = [" ".join(f"{c}{j}" for j in range(8)) for c in "abc"]
    held = lambda i, part: f"<p>Lead{i} in {part} end{i}</p>"
    wrap = "<article>{}</article>" if in_article else "{}"
    rows = [(i, f"http://h.org/{i}", wrap.format("".join(held(f"{i}x{k}", p) for k, p in enumerate(parts[: 2 + i // 3])))) for i in range(4)]
    rows += [(10, "http://h.org/a", f"<p>Own words {10}</p><p>{parts[0]} {parts[1]}</p><p>{parts[1]} {parts[2]}</p>")]
    rows += [(11, "http://o.org/a", f"<p>{parts[0]} {parts[1]}</p>"), (12, "http://h.org/b", f"<article>{parts[1]} {parts[0]}</article>")]
    expected = _by_rule(rows)
    assert expected[10] == f"Own words 10 {parts[1]} {parts[2]}" and expected[12] and expected[11]
    for shard_texts in (5_000, 2):
        out = pages.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3), shard_texts).collect()
        assert {r.page_id: r.text for r in out} == expected


def test_pages_of_common_words_follow_the_rule(spark, monkeypatch):
    """Random blocks of few words, in which runs recur at any place, against the rule, by brute force."""
    rng = np.random.default_rng(11)
    phrases = [" ".join(rng.choice(list("abcdef"), rng.integers(4, 9))) for _ in range(12)]
    rows = []
    for i in range(60):
        blocks = [" ".join(rng.choice(phrases, rng.integers(1, 5))) for _ in range(5)]
        body = "".join(f"<p>{b}</p>" for b in [*blocks, f"Page {i}"])
        rows.append((i, f"http://h{i % 2}.org/{i}", f"<main>{body}</main>" if i % 3 == 0 else body))
    expected = _by_rule(rows)
    monkeypatch.setattr(pages, "FILTER_RUNS", 40)  # hosts are looked through in turns
    for shard_texts in (5_000, 7):
        out = pages.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3), shard_texts).collect()
        assert {r.page_id: r.text for r in out} == expected


def test_unclosed_tags_take_linear_time():
    import time

    for tag in ("<nav>", "<div>", "<nav><main>", "<li>"):
        began = time.process_time()
        pages.blocks_of(tag * (500_000 // len(tag)) + "x")
        assert time.process_time() - began < 5


def test_pipeline_packs_every_kept_document(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.store(stage(spark, docs, SF), "stage")
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == {r.doc_id for r in docs.collect()}


def test_all_are_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
