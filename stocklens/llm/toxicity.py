"""Toxicity: a weighted lexicon found by an Aho-Corasick automaton in folded text.

Texts are folded first: lower case, homoglyphs to Latin letters, and digits or signs between letters
to the letters they stand for. A word that still has digits or signs, at its edges, is folded in full if the whole of it is
then a word that the lexicon finds, and stays as it is otherwise. The lexicon (whole words and word beginnings) is chosen from labelled
documents: greedily, the entry that explains most toxic documents not yet explained and
stands in almost no clean ones. Phrases around an entry that mostly stand in clean documents are
exceptions. A document's score is a logistic function of the weight found and of that weight
divided by the logarithm of the length.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import map_batches, table
from stocklens.llm.labelled import fit_logistic, held_out, labelled_sample, sigmoid

FOLD, HELD = 5, 0
#: Labelled documents that lexicon and score are fitted on, at most.
TRAIN_ROWS = 10_000
#: Candidate entries considered for the lexicon (the best by log-odds), and entries in it, at most.
CANDIDATES, ENTRIES = 2_000, 200
MIN_DOCS = 3

# Look-alikes of Latin letters, and digits and signs used in their place.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ｌ": "l",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}

_HOMOGLYPHS = str.maketrans(HOMOGLYPHS)
_DIGITS = str.maketrans(DIGITS)
_FULL_WIDTH = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)}
_SWAPPED = re.compile(r"[^\W\d_]+[0134578@$]+[^\W\d_](?:[^\W_]|[@$])*")
_MIXED = re.compile(r"(?<![^\W_])[$@]*(?:[^\W_]|[@$])+")
_ODD = re.compile("[Ͱ-ԯ！-～]")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str | None) -> str:
    low = (text or "").lower()
    if _ODD.search(low):
        low = low.translate(_FULL_WIDTH).translate(_HOMOGLYPHS)
    return _SWAPPED.sub(lambda m: m[0].translate(_DIGITS), low)


def entries_of(folded: str) -> set[str]:
    """Candidates: whole words (marked by $) and their beginnings of 4 to 6 letters."""
    out = set()
    for word in set(_WORD.findall(folded)):
        out.add(f"{word}$")
        out.update(word[:k] for k in (4, 5, 6) if len(word) > k)
    return out


def fold_edges(folded: str, automaton: object) -> str:
    """A folded text with its words of letters, digits and signs folded in full where that makes a lexicon hit of the whole word."""
    if not len(automaton):
        return folded

    def full(m: re.Match) -> str:
        word = m[0]
        if word.isalpha() or not any(c.isalpha() for c in word):
            return word
        made = word.translate(_DIGITS)
        return made if made.isalpha() and any(start == 0 and end == len(made) for start, end, _ in hits(made, automaton)) else word

    return _MIXED.sub(full, folded)


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: frozenset[str]
    model: np.ndarray

    def automaton(self):  # noqa: ANN201
        import ahocorasick

        by_text: dict[str, list[tuple[bool, float]]] = defaultdict(list)
        for entry, weight in self.weights.items():
            by_text[entry.removesuffix("$")].append((entry.endswith("$"), weight))
        found = ahocorasick.Automaton()
        for text, kinds in by_text.items():
            found.add_word(text, (len(text), kinds))
        if by_text:
            found.make_automaton()
        return found


def hits(folded: str, automaton: object) -> list[tuple[int, int, float]]:
    """(start, end of the word, weight) of entries at a word's beginning; one per word, the heaviest."""
    best: dict[int, tuple[int, int, float]] = {}
    if not len(automaton):
        return []
    for last, (size, kinds) in automaton.iter(folded):
        start, end = last + 1 - size, last + 1
        if start and folded[start - 1].isalpha():
            continue
        while end < len(folded) and folded[end].isalpha():
            end += 1
        for whole, weight in kinds:
            if (not whole or end == last + 1) and (start not in best or best[start][2] < weight):
                best[start] = start, end, weight
    return list(best.values())


def neighbours(folded: str, start: int, end: int) -> tuple[str, str]:
    """The phrases of a hit with the word before and with the word after it."""
    before = _WORD.findall(folded[max(0, start - 40) : start])
    after = _WORD.search(folded[end : end + 40])
    word = folded[start:end]
    return f"{before[-1] if before else ''} {word}", f"{word} {after[0] if after else ''}"


def total_weight(folded: str, automaton: object, exceptions: frozenset[str]) -> float:
    found = hits(folded, automaton)
    if exceptions:
        found = [h for h in found if not exceptions.intersection(neighbours(folded, h[0], h[1]))]
    return sum(weight for _, _, weight in found)


def signals(weight: float, text: str | None) -> list[float]:
    """Model inputs: whether anything was found, its weight, and its weight by length."""
    return [float(weight > 0), min(weight, 20.0) / 10, min(weight, 20.0) / np.log2(4 + (text or "").count(" "))]


def fit_lexicon(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, exceptions: frozenset[str] = frozenset()) -> Lexicon:
    """Learn entries, exceptions and the score from at most `train_rows` labelled documents outside the
    held-out fold. Entry counts are made on the executors; the driver gets at most CANDIDATES
    of them and, per sampled document, which of those it has. Without labels: nothing is toxic."""
    sample = labelled_sample(docs, labels, "toxic", FOLD, HELD, train_rows).select("text", (F.col("y") > 0).alias("toxic"))

    def count(rows: dict[str, list]) -> dict[str, list]:
        bad: Counter = Counter()
        good: Counter = Counter()
        for text, toxic in zip(rows["text"], rows["toxic"], strict=True):
            (bad if toxic else good).update(entries_of(fold(text)))
        return _counted(bad, good)

    counted = map_batches(sample, count, "entry string, bad bigint, good bigint").groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    sizes = sample.agg(F.count_if("toxic"), F.count_if(~F.col("toxic"))).first()
    odds = F.log((F.col("bad") + 0.5) / (sizes[0] + 1.0)) - F.log((F.col("good") + 0.5) / (sizes[1] + 1.0))
    best = counted.where(F.col("bad") >= MIN_DOCS).withColumn("odds", odds).where("odds > 2").orderBy(F.desc("odds"), "entry").limit(CANDIDATES).collect()
    names = [r["entry"] for r in best]
    index = {e: i for i, e in enumerate(names)}

    def which(rows: dict[str, list]) -> dict[str, list]:
        return {"toxic": rows["toxic"], "own": [[index[e] for e in entries_of(fold(t)) if e in index] for t in rows["text"]]}

    open_docs = [set(r["own"]) for r in map_batches(sample.where("toxic"), which, "toxic boolean, own array<int>").limit(train_rows).collect() if r["own"]]
    chosen: dict[str, float] = {}
    while open_docs and len(chosen) < ENTRIES:
        gain = Counter(i for own in open_docs for i in own)
        # Most documents explained; of equals the one with higher odds (the lower index).
        i, n = max(gain.items(), key=lambda x: (x[1] * (best[x[0]]["good"] == 0), x[1], -x[0]))
        if n < MIN_DOCS:
            break
        chosen[names[i]] = float(best[i]["odds"])
        open_docs = [own for own in open_docs if i not in own]

    rules = Lexicon(chosen, exceptions, np.zeros(4))

    def around(rows: dict[str, list]) -> dict[str, list]:
        found = rules.automaton()
        out: dict[str, list] = {"phrase": [], "toxic": []}
        for text, toxic in zip(rows["text"], rows["toxic"], strict=True):
            folded = fold_edges(fold(text), found)
            near = {p for start, end, _ in hits(folded, found) for p in neighbours(folded, start, end)}
            out["phrase"] += near
            out["toxic"] += [toxic] * len(near)
        return out

    phrases = map_batches(sample, around, "phrase string, toxic boolean").groupBy("phrase").agg(F.count_if("toxic").alias("bad"), F.count_if(~F.col("toxic")).alias("good"))
    clean = phrases.where((F.col("good") >= MIN_DOCS) & (F.col("bad") * 10 < F.col("good"))).orderBy(F.desc("good"), "phrase").limit(CANDIDATES)
    rules.exceptions = exceptions | {r["phrase"] for r in clean.collect()}

    def measure(rows: dict[str, list]) -> dict[str, list]:
        found = rules.automaton()
        return {"toxic": rows["toxic"], "x": [signals(total_weight(fold_edges(fold(t), found), found, rules.exceptions), t) for t in rows["text"]]}

    got = map_batches(sample, measure, "toxic boolean, x array<double>").limit(2 * train_rows).collect()
    rules.model = fit_logistic(np.array([r["x"] for r in got], float).reshape(-1, 3), np.array([r["toxic"] for r in got], float))
    return rules


def _counted(bad: Counter, good: Counter) -> dict[str, list]:
    every = list(bad | good)
    return {"entry": every, "bad": [bad[e] for e in every], "good": [good[e] for e in every]}


def score_toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, from its whole text (null as empty)."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)
    built: list[object] = []

    def run(rows: dict[str, list]) -> dict[str, list]:
        rules = sent.value
        if not built:
            built.append(rules.automaton())
        x = np.array([signals(total_weight(fold_edges(fold(t), built[0]), built[0], rules.exceptions), t) for t in rows["text"]], float).reshape(-1, 3)
        return {"doc_id": rows["doc_id"], "held_out": rows["held_out"], "score": sigmoid(x @ rules.model[:-1] + rules.model[-1])}

    id_type = dict(docs.dtypes)["doc_id"]
    scored = map_batches(docs.select("doc_id", held_out(FOLD, HELD).alias("held_out"), "text"), run, f"doc_id {id_type}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity_scores(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_lexicon(docs, table(spark, sf_dir, "labels")))
