"""Scoring texts with a small causal self-attention model over subword ids.

A token is a word or the end of a text. The model gives P(token | context) as
P(class | context) x P(word | class). A word's subword ids decide its class: a mixture of subword
distributions, fitted by expectation-maximisation, times the kind of its last character. The
class of the next token comes from masked self-attention over the words before it (each the mean of its
subwords' component posteriors), trained in numpy. The word within its class comes from the
counts of the whole training fold, and a word never seen there from the class's share of
new words times its spelling in subwords.

Mixture and attention begin on a bounded number of chunks, which only decide where they begin. Then both learn from
every word of every training document: the mixture by a step of expectation-maximisation whose expected counts Spark
adds up and which replaces it, the attention by descent over all texts in every task and weighted means of the
parameters. All counts are over all training documents, and the counts that do not fit a worker (all but the HEAD most
frequent words) are joined by Spark. Texts are scored in windows that overlap by half, every token once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import as_long, crc32_mod, map_batches, split_words, store, word_hashes
from stocklens.llm.subwords import of_ranks

FOLD, HELD = 7, 2
#: Words of a chunk, whose component the mixture looks for.
CHUNK = 48
#: Documents and chunks of each on which mixture and attention begin, by hash.
START_DOCS, START_CHUNKS = 1_200, 6
#: Rate of the descent over all training texts, and words that a task joins for it.
PASS_RATE, JOINED = 0.003, 200_000
#: Most frequent words whose counts go to every worker, at most.
HEAD = 1 << 17
COMPONENTS, KINDS = 12, 4
CLASSES = COMPONENTS * KINDS + 1  # the last one is the end of a text
END_CLASS = CLASSES - 1
WIDTH = COMPONENTS + KINDS
HIDDEN = 32
#: Tokens scored in a window, and context before them.
SPAN = 16
TOP_SUBWORDS = 3_000
FLOOR = 1e-3
CACHED = 100_000


def kinds(words: list[bytes]) -> np.ndarray:
    """By the last byte: 1 full stop, 2 comma, 3 other ASCII signs, 0 letters, digits and the rest."""
    last = np.array([w[-1] for w in words], np.int64)
    letter = (last >= 128) | ((last >= 48) & (last <= 57)) | ((last >= 97) & (last <= 122))
    return np.where(last == 46, 1, np.where(last == 44, 2, np.where(letter, 0, 3)))


# ------------------------------------------------------------------------ model
@dataclass
class Model:
    path: str
    pattern: str
    log_theta: np.ndarray  # subword x component
    log_prior: np.ndarray
    net: dict[str, np.ndarray] = field(default_factory=dict)
    #: Per class: log10 of (all + types + 1), and of (types + 1); per component: log10 P(subword), end at the last row.
    class_all: np.ndarray = field(default_factory=lambda: np.zeros(CLASSES))
    class_new: np.ndarray = field(default_factory=lambda: np.zeros(CLASSES))
    spelling: np.ndarray | None = None

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Vectors, classes, flat subword ids and their begins."""
        ids, begins = of_ranks(self.path, self.pattern).flat([f" {w.decode()}" for w in words])
        if not len(begins):
            return np.zeros((0, WIDTH), np.float32), np.zeros(0, np.int64), ids, begins
        total = np.add.reduceat(self.log_theta[ids], begins) + self.log_prior
        component = total.argmax(1)
        total -= total.max(1, keepdims=True)
        posterior = np.exp(total)
        posterior /= posterior.sum(1, keepdims=True)
        kind = kinds(words)
        return np.hstack([posterior, np.eye(KINDS)[kind]]).astype(np.float32), component * KINDS + kind, ids, begins

    def spell(self, classes: np.ndarray, ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """log10 probability of the words' subword sequences under their component."""
        sizes = np.diff(np.append(begins, len(ids)))
        component = classes // KINDS
        each = self.spelling[ids, np.repeat(component, sizes)]
        return np.add.reduceat(each, begins) + self.spelling[-1, component]


def fit_mixture(counts: np.ndarray, seed: int = 7, steps: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """Mixture of unigrams over chunks (rows of subword counts): log P(subword | component), log prior."""
    random = np.random.default_rng(seed)
    n, size = counts.shape
    theta = np.full((COMPONENTS, size), 1.0 / size)
    prior = np.full(COMPONENTS, 1.0 / COMPONENTS)
    if n:
        whole = counts.sum(0) + 0.5
        for k, row in enumerate(random.choice(n, COMPONENTS, replace=n < COMPONENTS)):
            own = counts[row] + 0.05 * whole / whole.sum() * max(1.0, counts[row].sum())
            theta[k] = own / own.sum()
        for _ in range(steps):
            log = counts @ np.log(theta).T.astype(np.float32) + np.log(prior)
            log -= log.max(1, keepdims=True)
            share = np.exp(log)
            share /= share.sum(1, keepdims=True)
            prior = (share.sum(0) + 1) / (n + COMPONENTS)
            theta = share.T @ counts + 20 * whole / whole.sum() + 1e-3
            theta /= theta.sum(1, keepdims=True)
    return np.log(theta).T, np.log(prior)


def new_net(seed: int = 11) -> dict[str, np.ndarray]:
    random = np.random.default_rng(seed)
    shape = {"q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH), "h": (2 * WIDTH, HIDDEN), "o": (HIDDEN, CLASSES)}
    net = {n: (random.normal(size=s) / math.sqrt(s[0])).astype(np.float32) for n, s in shape.items()}
    return net | {"b": np.zeros(2 * SPAN, np.float32), "hb": np.zeros(HIDDEN, np.float32), "ob": np.zeros(CLASSES, np.float32)}


def forward(net: dict[str, np.ndarray], x: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Log probabilities of the next token's class at every position of the joined texts.

    `begin` is the first position of each position's text: attention never leaves it. Windows hold
    SPAN positions to score and the SPAN before them; all windows are one batch."""
    n = len(x)
    n_windows = -(-n // SPAN)
    tail = n_windows * SPAN - n
    padded = np.concatenate([np.zeros((SPAN, WIDTH), np.float32), x, np.zeros((tail, WIDTH), np.float32)])
    # The overlap: each block is scored once and read twice, as its own and as the context of the next.
    twice = lambda y: np.concatenate([y[:-SPAN].reshape(n_windows, SPAN, -1), y[SPAN:].reshape(n_windows, SPAN, -1)], 1)
    own = padded[SPAN:].reshape(n_windows, SPAN, WIDTH)
    q = (padded[SPAN:] @ net["q"] * np.float32(1 / math.sqrt(WIDTH))).reshape(n_windows, SPAN, WIDTH)
    k, v = twice(padded @ net["k"]), twice(padded @ net["v"])
    lag = np.arange(SPAN)[:, None] - np.arange(-SPAN, SPAN)[None, :]
    a = q @ k.transpose(0, 2, 1)
    a += np.where(lag < 0, np.float32(-1e9), net["b"][np.clip(lag, 0, 2 * SPAN - 1)])
    # Positions before the text's own begin, in the windows that reach any.
    since = (np.concatenate([begin, np.arange(n, n + tail)]) - np.repeat(np.arange(n_windows) * SPAN, SPAN)).reshape(n_windows, SPAN)
    reach = np.nonzero((since > -SPAN).any(1))[0]
    a[reach] += np.float32(-1e9) * (np.arange(-SPAN, SPAN) < since[reach][:, :, None])
    a -= a.max(2, keepdims=True)
    np.exp(a, out=a)
    a /= a.sum(2, keepdims=True)
    both = np.concatenate([a @ v, own], 2).reshape(-1, 2 * WIDTH)
    h = both @ net["h"]
    h += net["hb"]
    np.maximum(h, 0, out=h)
    z = h @ net["o"]
    z += net["ob"]
    z -= z.max(1, keepdims=True)
    z -= np.log(np.exp(z).sum(1, keepdims=True))
    return z[:n], {"own": own, "padded": padded, "q": q, "k": k, "v": v, "a": a, "both": both, "h": h, "lag": lag, "z": z}


def gradients(net: dict[str, np.ndarray], kept: dict[str, np.ndarray], target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross-entropy; positions past the end have weight 0."""
    n_windows = len(kept["own"])
    d = np.exp(kept["z"])
    d[: len(target)][np.arange(len(target)), target] -= 1
    d[: len(target)] *= (weight / max(1.0, float(weight.sum())))[:, None]
    d[len(target) :] = 0
    g = {"o": kept["h"].T @ d, "ob": d.sum(0)}
    dh = d @ net["o"].T * (kept["h"] > 0)
    g |= {"h": kept["both"].T @ dh, "hb": dh.sum(0)}
    dboth = (dh @ net["h"].T).reshape(n_windows, SPAN, 2 * WIDTH)
    dr = dboth[:, :, :WIDTH]
    da = dr @ kept["v"].transpose(0, 2, 1)
    dv = kept["a"].transpose(0, 2, 1) @ dr
    ds = kept["a"] * (da - (da * kept["a"]).sum(2, keepdims=True))
    g["b"] = np.bincount(np.clip(kept["lag"], 0, 2 * SPAN - 1).ravel(), ds.sum(0).ravel(), 2 * SPAN)
    flat = lambda y: y.reshape(-1, y.shape[-1])
    g["q"] = flat(kept["own"]).T @ flat(ds @ kept["k"]) * np.float32(1 / math.sqrt(WIDTH))
    for name, d_twice in (("k", ds.transpose(0, 2, 1) @ kept["q"]), ("v", dv)):
        once = np.zeros((n_windows + 1, SPAN, WIDTH), d_twice.dtype)
        once[:-1] += d_twice[:, :SPAN]
        once[1:] += d_twice[:, SPAN:]
        g[name] = kept["padded"].T @ flat(once)
    return g


class Descent:
    """Adam over slices of joined texts, from a net on."""

    def __init__(self, net: dict[str, np.ndarray], batch: int = 8192) -> None:
        self.net, self.batch, self.step = dict(net), batch, 0
        self.first = {n: np.zeros_like(p) for n, p in net.items()}
        self.second = {n: np.zeros_like(p) for n, p in net.items()}

    def over(self, x: np.ndarray, begin: np.ndarray, target: np.ndarray, weight: np.ndarray, rate: float) -> None:
        for at in range(0, len(x), self.batch):
            part = slice(at, at + self.batch)
            self.step += 1
            _, kept = forward(self.net, x[part], np.maximum(begin[part] - at, 0))
            for name, g in gradients(self.net, kept, target[part], weight[part]).items():
                self.first[name] = 0.9 * self.first[name] + 0.1 * g
                self.second[name] = 0.99 * self.second[name] + 0.01 * g * g
                grown = self.first[name] / (1 - 0.9**self.step) / (np.sqrt(self.second[name] / (1 - 0.99**self.step)) + 1e-8)
                self.net[name] = (self.net[name] - rate * grown).astype(np.float32)


def fit_net(x: np.ndarray, begin: np.ndarray, target: np.ndarray, weight: np.ndarray, epochs: int = 4, rate: float = 0.01) -> dict[str, np.ndarray]:
    """A new net after so many rounds over joined texts, the rate halved each time."""
    net = new_net()
    if weight.sum():
        share = np.bincount(target, weight, CLASSES) + 0.5
        net["ob"] = np.log(share / share.sum()).astype(np.float32)
    descent = Descent(net)
    for epoch in range(epochs):
        descent.over(x, begin, target, weight, rate * 0.5**epoch)
    return descent.net


# ------------------------------------------------------------------ over Spark
def is_held_out() -> F.Column:
    return F.coalesce(crc32_mod("doc_id", FOLD) == HELD, F.lit(False))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, h, c) over all training documents; the end of a text is the empty word."""

    def run(rows: dict[str, list]) -> dict[str, list]:
        found: Counter = Counter()
        for text in rows["text"]:
            found.update(split_words(text, lower=True))
        found[b""] = len(rows["text"])
        words = list(found)
        return {"word": [w.decode() for w in words], "h": [_hash(w) for w in words], "c": list(found.values())}

    counted = map_batches(docs.where(~is_held_out()).select("text"), run, "word string, h bigint, c bigint", rows_at_once=10_000)
    return store(counted.groupBy("word", "h").agg(F.sum("c").alias("c")), "word_counts")


def _hash(word: bytes) -> int:
    value = xxhash.xxh3_64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


Chunk = tuple[bool, bool, list[bytes]]  # whether it starts a text, whether it ends one, its words


def start_chunks(docs: DataFrame) -> list[Chunk]:
    """The START_CHUNKS chunks of least hash of START_DOCS training documents: where the model begins, not what it learns."""

    def run(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"starts": [], "ends": [], "words": []}
        for text in rows["text"]:
            words = split_words(text, lower=True)
            n = max(1, -(-len(words) // CHUNK))
            keys = [xxhash.xxh3_64_intdigest(f"{len(words)} {i}") for i in range(n)]
            for i in sorted(sorted(range(n), key=keys.__getitem__)[:START_CHUNKS]):
                out["starts"].append(i == 0)
                out["ends"].append(i == n - 1)
                out["words"].append(b" ".join(words[i * CHUNK : (i + 1) * CHUNK]).decode())
        return out

    training = docs.where(~is_held_out()).select("doc_id", "text")
    chosen = training.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(START_DOCS)
    made = map_batches(training.join(F.broadcast(chosen), "doc_id", "left_semi").select("text"), run, "starts boolean, ends boolean, words string")
    rows = made.orderBy(F.xxhash64("words"), "words", "starts").limit(START_DOCS * START_CHUNKS).collect()
    return [(r["starts"], r["ends"], r["words"].encode().split()) for r in rows]


def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[list[list[bytes]]]:
    """The words of a task's texts, as many texts at a time as have JOINED words together."""
    group, size = [], 0
    for batch in batches:
        for text in batch.column("text"):
            group.append(split_words(text.as_py(), lower=True))
            size += len(group[-1]) + 1
            if size >= JOINED:
                yield group
                group, size = [], 0
    if group:
        yield group


def numbered(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words, and the place of each word among them."""
    distinct = list(dict.fromkeys(words))
    place = dict(zip(distinct, range(len(distinct)), strict=True))
    return distinct, np.fromiter(map(place.__getitem__, words), np.int64, len(words))


def start_model(chunks: list[Chunk], path: str, pattern: str) -> Model:
    """A mixture fitted on these chunks."""
    pieces = of_ranks(path, pattern)
    flat = [pieces.flat([f" {w.decode()}" for w in words])[0] for _, _, words in chunks]
    total = np.bincount(np.concatenate([*flat, np.empty(0, np.int64)]), minlength=pieces.size)
    top = np.argsort(-total, kind="stable")[:TOP_SUBWORDS]
    column = np.full(pieces.size, TOP_SUBWORDS)
    column[top] = np.arange(TOP_SUBWORDS)
    counts = np.zeros((len(flat), TOP_SUBWORDS + 1), np.float32)
    for row, ids in zip(counts, flat, strict=True):
        np.add.at(row, column[ids], 1)
    log_theta, log_prior = fit_mixture(counts)
    log_theta = log_theta[column]
    log_theta[column == TOP_SUBWORDS] -= math.log(pieces.size - TOP_SUBWORDS)
    return Model(path, pattern, log_theta, log_prior)


def examples(model: Model, chunks: list[Chunk]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, begins, targets, weights) of joined chunks. Inputs are the start and the words; targets the words and
    the end. Inside a text, the first word of a chunk is only context."""
    sizes = np.array([len(words) for _, _, words in chunks], np.int64)
    distinct, at = numbered([w for _, _, words in chunks for w in words])
    vectors, classes, _, _ = model.words(distinct)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)[: len(chunks)]
    n = int((sizes + 1).sum())
    at_start, at_end = np.zeros(n, bool), np.zeros(n, bool)
    at_start[starts], at_end[starts + sizes] = True, True
    x = np.zeros((n, WIDTH), np.float32)
    x[~at_start] = vectors[at]
    target = np.full(n, END_CLASS)
    target[~at_end] = classes[at]
    weight = np.ones(n)
    weight[starts] = [float(a) for a, _, _ in chunks]
    # The only target of a chunk without words is its end.
    ends = np.array([float(b) for _, b, _ in chunks])
    weight[starts + sizes] = np.where(sizes > 0, ends, np.minimum(ends, weight[starts]))
    return x, np.repeat(starts, sizes + 1), target, weight


def mixture_pass(model: Model, training: DataFrame) -> None:
    """One step of expectation-maximisation over the chunks of all training texts: every subword's expected counts, a row
    of COMPONENTS numbers a task, are added up by Spark and replace the mixture's."""
    sent = training.sparkSession.sparkContext.broadcast((model.path, model.pattern, model.log_theta, model.log_prior))
    names = [f"c{k}" for k in range(COMPONENTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, pattern, log_theta, log_prior = sent.value
        pieces = of_ranks(path, pattern)
        # The chunks themselves, for the prior, stand in the last column and go out under -1.
        table = np.zeros((COMPONENTS, len(log_theta) + 1))
        for texts in joined(batches):
            distinct, at = numbered([w for words in texts for w in words])
            if not distinct:
                continue
            ids, begins = pieces.flat([f" {w.decode()}" for w in distinct])
            ends = np.cumsum([len(words) for words in texts])
            firsts = np.concatenate([np.arange(end - len(words), end, CHUNK) for end, words in zip(ends, texts, strict=True)])
            log = np.add.reduceat(np.add.reduceat(log_theta[ids], begins)[at], firsts) + log_prior
            share = np.exp(log - log.max(1, keepdims=True))
            share /= share.sum(1, keepdims=True)
            of_chunk = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, len(at))))
            sizes = np.diff(np.append(begins, len(ids)))
            for k, own in enumerate(np.ascontiguousarray(share.T)):
                expected = np.bincount(at, own[of_chunk], len(distinct))
                table[k, :-1] += np.bincount(ids, np.repeat(expected, sizes), len(log_theta))
                table[k, -1] += own.sum()
        seen = np.nonzero(table.any(0))[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.where(seen < len(log_theta), seen, -1)), *[pa.array(row[seen]) for row in table]], ["subword", *names])

    counted = training.select("text").mapInArrow(run, "subword bigint, " + ", ".join(f"{c} double" for c in names))
    got = counted.groupBy("subword").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
    subword, values = np.asarray(got["subword"]), np.stack([np.asarray(got[c]) for c in names], axis=1)
    if not len(subword):
        return
    n_chunks = values[subword < 0].sum(0)
    counts = np.zeros((len(model.log_theta), COMPONENTS))
    counts[subword[subword >= 0]] = values[subword >= 0]
    whole = counts.sum(1) + 0.5
    theta = counts + 20 * (whole / whole.sum())[:, None] + 1e-6
    model.log_theta = np.log(theta / theta.sum(0)).astype(model.log_theta.dtype)
    model.log_prior = np.log((n_chunks + 1) / (n_chunks.sum() + COMPONENTS))


def net_pass(model: Model, training: DataFrame, rate: float) -> dict[str, np.ndarray]:
    """The net after a pass over all training texts: every task descends from the model's net over its own texts, and Spark
    takes the mean of their parameters, weighted by the tokens they learned from."""
    sent = training.sparkSession.sparkContext.broadcast(model)
    names = sorted(model.net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        descent, seen = Descent(own.net), 0.0
        for texts in joined(batches):
            data = examples(own, [(True, True, words) for words in texts])
            descent.over(*data, rate)
            seen += float(data[3].sum())
        if seen:
            flat = np.concatenate([descent.net[n].ravel() for n in names]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat * seen), pa.array(np.full(len(flat), seen))], ["at", "value", "seen"])

    made = training.select("text").mapInArrow(run, "at bigint, value double, seen double")
    got = made.groupBy("at").agg((F.sum("value") / F.sum("seen")).alias("value")).toArrow()
    if not got.num_rows:
        return model.net
    flat = np.zeros(got.num_rows, np.float32)
    flat[np.asarray(got["at"])] = np.asarray(got["value"])
    out, at = {}, 0
    for n in names:
        size = model.net[n].size
        out[n] = flat[at : at + size].reshape(model.net[n].shape)
        at += size
    return out


def fit_model(docs: DataFrame, path: str, pattern: str) -> Model:
    """Mixture and attention: begun on a few chunks, then fitted on all texts of the training documents."""
    training, start = docs.where(~is_held_out()).select("text"), start_chunks(docs)
    model = start_model(start, path, pattern)
    mixture_pass(model, training)
    model.net = fit_net(*examples(model, start))
    model.net = net_pass(model, training, PASS_RATE)
    return model


def fill_counts(model: Model, counts: DataFrame) -> None:
    """Class totals and spelling, from the counts of all training words: at most CLASSES rows and one row
    per component and subword reach the driver."""
    sent = counts.sparkSession.sparkContext.broadcast(model)
    end_row = of_ranks(model.path, model.pattern).size

    def run(rows: dict[str, list]) -> dict[str, list]:
        own = sent.value
        words = [w.encode() for w in rows["word"]]
        c = np.array(rows["c"], np.int64)
        _, classes, ids, begins = own.words(words)
        sizes = np.diff(np.append(begins, len(ids)))
        totals, types = np.bincount(classes, c, CLASSES).astype(np.int64), np.bincount(classes, minlength=CLASSES)
        component = classes // KINDS
        keys, n = np.unique(np.concatenate([ids, np.full(len(words), end_row)]) * COMPONENTS + np.concatenate([np.repeat(component, sizes), component]), return_counts=True)
        seen = np.nonzero(types)[0]
        return {
            "kind": [0] * len(seen) + [1] * len(keys), "key": np.concatenate([seen, keys]),
            "n": np.concatenate([totals[seen], n]), "types": np.concatenate([types[seen], np.zeros(len(keys), np.int64)]),
        }

    made = map_batches(counts.where("word <> ''").select("word", "c"), run, "kind int, key bigint, n bigint, types bigint")
    got = made.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("types").alias("types")).toArrow().to_pydict()
    kind, key, n, types = (np.array(got[c], np.int64) for c in ("kind", "key", "n", "types"))
    all_, new = np.zeros(CLASSES), np.zeros(CLASSES)
    all_[key[kind == 0]], new[key[kind == 0]] = n[kind == 0], types[kind == 0]
    model.class_all, model.class_new = np.log10(all_ + new + 1), np.log10(new + 1)
    table = np.zeros((end_row + 1) * COMPONENTS)
    table[key[kind == 1]] = n[kind == 1]
    table = table.reshape(-1, COMPONENTS)
    shared = table.sum(1) + 0.5
    table = table + 50 * (shared / shared.sum())[:, None]
    model.spelling = np.log10(table / table.sum(0)).astype(np.float32)


def frequent_words(counts: DataFrame, most: int = HEAD) -> dict[bytes, int]:
    """Words by falling count, as far as whole count bands fit `most` words."""
    band = F.floor(F.log2("c") * 8)
    sizes = sorted(((r["band"], r["count"]) for r in counts.groupBy(band.alias("band")).count().collect()), reverse=True)
    lowest, total = None, 0
    for at, n in sizes:
        total += n
        if total > most:
            break
        lowest = at
    if lowest is None:
        return {}
    return {r["word"].encode(): r["c"] for r in counts.where(band >= lowest).select("word", "c").collect()}


class Known:
    """A worker's table of words: vectors, classes, counts, log probabilities."""

    def __init__(self, model: Model, head: dict[bytes, int]) -> None:
        self.model, self.head = model, head
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.vectors, self.classes = np.zeros((0, WIDTH), np.float32), np.zeros(0, np.int64)
        self.count, self.new = np.zeros(0, np.int64), np.zeros(0)
        self.hashes = np.zeros(0, np.int64)

    def lookup(self, words: list[bytes]) -> np.ndarray:
        fresh = list({w for w in words if w not in self.index})
        if fresh:
            if len(self.index) + len(fresh) > CACHED:
                self.clear()
                fresh = list(set(words))
            at = len(self.index)
            self.index.update(zip(fresh, range(at, at + len(fresh)), strict=True))
            vectors, classes, ids, begins = self.model.words(fresh)
            new = self.model.class_new[classes] + self.model.spell(classes, ids, begins)
            self.vectors, self.classes = np.concatenate([self.vectors, vectors]), np.concatenate([self.classes, classes])
            self.count = np.concatenate([self.count, np.fromiter((self.head.get(w, 0) for w in fresh), np.int64, len(fresh))])
            self.new = np.concatenate([self.new, new])
            self.hashes = np.concatenate([self.hashes, as_long(word_hashes(fresh))])
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))


ROW = (
    "held_out boolean, n_tokens bigint, n_known bigint, base double, score double, "
    "h array<bigint>, tf array<int>, new array<float>"
)


def _score_texts(known: Known, texts: list[list[bytes]]) -> dict[str, list]:
    """Sums over the words with known counts, attention, and the other words with their numbers."""
    model, net = known.model, known.model.net
    out: dict[str, list] = {c: [] for c in ("n_tokens", "n_known", "base", "score", "h", "tf", "new")}
    index = known.lookup([w for words in texts for w in words])
    sizes = np.array([len(words) for words in texts])
    ends = np.cumsum(sizes)
    # One start per text, then its words; targets are the words, then one end.
    starts = np.concatenate([[0], ends[:-1]]) + np.arange(len(texts))
    x = np.zeros((len(index) + len(texts), WIDTH), np.float32)
    target = np.full(len(x), END_CLASS)
    is_start = np.zeros(len(x), bool)
    is_start[starts] = True
    x[~is_start] = known.vectors[index]
    is_end = np.zeros(len(x), bool)
    is_end[starts + sizes] = True
    target[~is_end] = known.classes[index]
    begin = np.repeat(starts, sizes + 1)
    log = np.empty(len(x))
    for at in range(0, len(x), 1 << 14):  # slices begin one span early, for their context
        low = max(0, at - SPAN)
        part = slice(low, at + (1 << 14))
        z, _ = forward(net, x[part], np.maximum(begin[part] - low, 0))
        own = np.exp(z[at - low :][np.arange(len(z) - (at - low)), target[at : at + (1 << 14)]])
        log[at : at + (1 << 14)] = np.log10((1 - FLOOR) * own + FLOOR / CLASSES)
    attention = np.add.reduceat(log, starts)
    for i, n in enumerate(sizes):
        own = index[ends[i] - n : ends[i]]
        c = known.count[own]
        rare, tf = np.unique(own[c == 0], return_counts=True)
        c = c[c > 0]
        out["n_tokens"].append(int(n) + 1)
        out["n_known"].append(len(c))
        out["base"].append(float(np.log10(c + 1).sum()))
        out["score"].append(float(attention[i] + np.log10(c).sum() - model.class_all[known.classes[own]].sum()))
        out["h"].append(known.hashes[rare])
        out["tf"].append(tf.astype(np.int32))
        out["new"].append(known.new[rare].astype(np.float32))
    return out


def score_documents(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row, from its whole text."""
    spark = docs.sparkSession
    n, v = counts.agg(F.sum("c"), F.count("*")).first()
    n, v = n or 0, v or 0
    n_ends = sum(r["c"] for r in counts.where("word = ''").collect())
    sent = spark.sparkContext.broadcast((model, frequent_words(counts.where("word <> ''"))))
    built: list[Known] = []

    def run(rows: dict[str, list]) -> dict[str, list]:
        if not built:
            built.append(Known(*sent.value))
        out: dict[str, list] = {"doc_id": rows["doc_id"], "held_out": rows["held_out"]}
        group: list[list[bytes]] = []
        for i, text in enumerate(rows["text"]):
            group.append(split_words(text, lower=True))
            if sum(map(len, group)) >= 60_000 or i == len(rows["text"]) - 1:
                for name, values in _score_texts(built[0], group).items():
                    out.setdefault(name, []).extend(values)
                group = []
        return out

    id_type = dict(docs.dtypes)["doc_id"]
    made = map_batches(docs.select("doc_id", is_held_out().alias("held_out"), "text"), run, f"doc_id {id_type}, {ROW}")
    made = store(made.withColumn("rid", F.monotonically_increasing_id()), "scored")
    rare = made.select("rid", F.explode(F.arrays_zip("h", "tf", "new")).alias("w")).select("rid", "w.h", "w.tf", "w.new")
    met = rare.join(counts.select("h", "c"), "h", "left")
    sums = met.groupBy("rid").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(0)).alias("more_known"),
        F.sum(F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("more_base"),
        F.sum(F.col("tf") * F.coalesce(F.log10("c"), F.col("new").cast("double"))).alias("more_score"),
    )
    whole = made.drop("h", "tf", "new").join(sums, "rid", "left")
    zero = F.lit(0)
    base = F.col("base") + F.coalesce("more_base", F.lit(0.0)) + F.lit(math.log10(n_ends + 1)) - F.col("n_tokens") * F.lit(math.log10(n + v + 1))
    return whole.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", zero) + F.lit(int(n_ends > 0))).cast("bigint").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"), base.alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


def lm_scores(docs: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """Train on the documents whose crc32(doc_id) mod 7 is not 2 and score all of them.

    Null and empty texts are one end. Null doc_ids are in no held-out fold and are counted as training text; rows repeating a doc_id
    are scored one by one. Without training documents all counts are zero. Other columns are ignored.
    """
    counts = word_counts(docs)
    model = fit_model(docs, vocabulary_path, pattern)
    fill_counts(model, counts)
    return score_documents(docs, model, counts)
