"""Fingerprints of documents that can be subtracted: invertible Bloom lookup sketches of their paragraphs.

A paragraph is a sentence or a line, its digest a 64-bit hash of it and of the times it stands in the text. A sketch
has three rows of 2^k cells. A digest goes into one cell of each row, where digests are counted and XORed, beside
a check hash. Subtracting the cells of two versions cancels what both have. Peeling then takes a cell that holds
a single digest, takes that digest out of its other two cells, and so on, until the cells are empty and the
differing digests are known. Where cells are left, the sketches were too small, and larger ones are tried.

All of it is DataFrame operations: cells are rows, one aggregate fills them, and each peeling step is an aggregate by
cell after taking out what the cells of one row hold alone (in one row a digest has one cell, so it is never
taken out twice). The rows of a document stay together from the join that brings its versions beside each other to
the end, so no step shuffles. The fingerprint of a text is its sketch folded to four cells a row.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocklens.llm.common import discard, small, store

#: Ends of paragraphs: a line feed, or white space after the end of a sentence.
PARAGRAPH_END = "\\n|(?<=[.!?;:|])\\s+"
#: Cells a row of a fingerprint (2^FOLD).
FOLD = 2
#: Cells a row of a sketch for each digest that can differ, before rounding up to a power of two; no effect on
#: results, only on how many pairs need a second attempt.
SIZE = 1.5
#: Text of a task in code points: its sketches have to fit in memory.
TASK_CHARS = 2_000_000
#: Peeling steps of one attempt, each over one of the three rows.
STEPS = 8
#: Keys that are broadcast after counting them; more are joined by shuffle.
BROADCAST_KEYS = 300_000
_KEY = ["k1", "k2"]
_STATE = [*_KEY, "part", "cell"]
# Parts of the state: sketch row + 4 * pair + 8 * bits; the fourth row holds what was peeled, parts below 0 the folds.
_PEELED = 3


def digests(text: str) -> list[Column]:
    """Steps to the paragraph digests of a text column, to be applied one after the other by with_digests."""
    paragraphs = F.filter(F.split(text, PARAGRAPH_END), lambda p: p != "")
    hashes = F.sort_array(F.transform(paragraphs, lambda p: F.xxhash64(p)))
    last = lambda s: F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == F.size(s) - 1) | (F.get(s, i) != F.get(s, i + 1)))
    times = lambda s, e: F.transform(e, lambda at, j: F.xxhash64(F.get(s, at), at - F.coalesce(F.get(e, j - 1), F.lit(-1))))
    return [hashes, last, times]


def with_digests(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with the distinct digests of a text column: a hash of each paragraph and of how often it stands there."""
    hashes, last, times = digests(text)
    none = F.array().cast("array<bigint>")
    df = df.withColumn("_s", hashes)
    df = df.withColumn("_e", F.when(F.size("_s") > 0, last(F.col("_s"))).otherwise(F.array().cast("array<int>")))
    found = F.array_distinct(times(F.col("_s"), F.col("_e")))
    return df.withColumn(out, F.when(F.size("_s") > 0, found).otherwise(none)).drop("_s", "_e")


# ------------------------------------------------------------ order of documents
def with_key(docs: DataFrame) -> DataFrame:
    """docs with `text` (null texts are empty) and k1, k2: a 128-bit hash of id and text stands for the document."""
    named = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return named.select("*", F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("k2"))


def successors(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, n1, n2, n_chars, copies), stored: each distinct document and the next one in descending
    doc_id (null ids last, then by key); after the last comes the first.

    Documents are range partitioned, so that each task finds the successors within its range; only the first
    document of each range (one a partition) meets the last one of the range before it.
    """
    nodes = with_key(docs).groupBy(*_KEY).agg(F.max("doc_id").alias("doc_id"), F.max(F.char_length("text")).alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    order = [F.desc_nulls_last("doc_id"), F.asc("k1"), F.asc("k2")]
    ranged = store(nodes.repartitionByRange(*order).withColumn("chunk", F.spark_partition_id()), "ranged")
    within = Window.partitionBy("chunk").orderBy(*order)
    follows = ranged.select("doc_id", *_KEY, "n_chars", "copies", "chunk", F.lead(F.struct(*_KEY)).over(within).alias("next"))
    heads = ranged.withColumn("at", F.row_number().over(within)).where("at = 1")
    chunks = Window.orderBy("chunk")
    every = chunks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    head = F.struct(*_KEY)
    following = heads.select("chunk", F.coalesce(F.lead(head).over(chunks), F.first(head).over(every)).alias("head"))
    joined = follows.join(F.broadcast(following), "chunk").withColumn("next", F.coalesce("next", "head"))
    made = store(joined.select("doc_id", *_KEY, F.col("next.k1").alias("n1"), F.col("next.k2").alias("n2"), "n_chars", "copies"), "successors")
    discard(ranged)
    return made


def versions(docs: DataFrame, order: DataFrame) -> DataFrame:
    """(k1, k2, text, edited, d_next) of each document in `order`: its text, its edited text, the digests of the next.

    Texts are shuffled once, by key, to tasks of about TASK_CHARS; of the next document its first code points and
    its digests travel. What reads this needs all of its columns, so that the shuffles are made only once."""
    size = order.agg(F.sum("n_chars")).first()[0] or 0
    tasks = size // TASK_CHARS + 1
    by_key = Window.partitionBy(*_KEY).orderBy(*_KEY)
    # Repeated rows have the same key: one of them is enough, `copies` counts them.
    texts = with_key(docs).select(*_KEY, "text").repartition(tasks, *_KEY)
    texts = texts.withColumn("seen", F.lag(F.lit(1)).over(by_key)).where("seen is null").drop("seen")
    named = order.select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), F.col("n1").alias("k1"), F.col("n2").alias("k2"), "n_chars")
    after = with_digests(named.join(texts, _KEY), "text", "d_next")
    tail = F.expr("substring(text, 1, n_chars div 2)").alias("tail")
    after = after.select(F.col("o1").alias("k1"), F.col("o2").alias("k2"), "n_chars", tail, "d_next").repartition(tasks, *_KEY)
    edited = F.concat(F.expr("substring(text, 1, n_chars - n_chars div 2)"), "tail").alias("edited")
    return texts.join(after, _KEY).select(*_KEY, "text", edited, "d_next")


# ------------------------------------------------------------ sketches
def _cell(digest: Column, row: Column | int, bits: Column) -> Column:
    """The cell of a digest in a row of 2^bits cells: the lowest bits of a hash, so that larger sketches fold onto
    smaller ones and digests that share a cell part as sketches grow."""
    one = F.lit(1).cast("bigint")
    place = F.xxhash64(digest, (F.lit(row) if isinstance(row, int) else row).cast("int"))
    return place.bitwiseAND(F.call_function("shiftleft", one, bits) - one)


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check"))


def sketches(versions: DataFrame, names: list[str], attempt: int) -> DataFrame:
    """(k1, k2, row, bits, cell and for each version x its count n_x, XOR of digests x_x and of checks c_x).

    A row has 2^bits cells, at least SIZE * 2^attempt for each digest of the largest two versions together."""
    sizes = [F.size(n) for n in names]
    least = F.greatest(F.lit(1), (sizes[0] + (F.greatest(*sizes[1:]) if len(sizes) > 2 else sizes[1])) * SIZE)
    bits = F.greatest(F.lit(FOLD), F.ceil(F.log2(least)).cast("int")) + attempt
    entries = F.array(*[F.struct(F.lit(i).alias("v"), F.col(n).alias("d")) for i, n in enumerate(names)])
    rows = versions.select(*_KEY, bits.alias("bits"), F.inline(entries)).select(*_KEY, "bits", "v", F.explode("d").alias("x"))
    rows = rows.select("*", _check(F.col("x")).alias("c"), F.explode(F.array(*map(F.lit, range(3)))).alias("row"))
    rows = rows.withColumn("cell", _cell(F.col("x"), F.col("row"), F.col("bits")))
    zero = F.lit(0).cast("bigint")
    sums = []
    for i, n in enumerate(names):
        own = lambda value, i=i: F.when(F.col("v") == i, value).otherwise(zero)
        sums += [F.sum(own(F.lit(1))).alias(f"n_{n}"), F.bit_xor(own(F.col("x"))).alias(f"x_{n}"), F.bit_xor(own(F.col("c"))).alias(f"c_{n}")]
    return rows.groupBy(*_KEY, "row", "bits", "cell").agg(*sums)


def subtracted(cells: DataFrame, pairs: list[tuple[str, str]], folded: list[str]) -> DataFrame:
    """The state to be peeled (k1, k2, part, cell, n, x, c): the cells of each pair of versions subtracted, and the
    sketches of `folded` at 2^FOLD cells a row (parts -1, -2, ...)."""
    small_cell = F.col("row") * (1 << FOLD) + F.col("cell").bitwiseAND(F.lit((1 << FOLD) - 1).cast("bigint"))
    which = F.col("which")

    def choice(values: list[Column]) -> Column:
        out = F.when(which == 0, values[0])
        for i, value in enumerate(values[1:], 1):
            out = out.when(which == i, value)
        return out

    parts = [F.col("row") + F.col("bits") * 8 + 4 * i for i in range(len(pairs))] + [F.lit(-1 - i) for i in range(len(folded))]
    differ = {
        "n": [F.col(f"n_{a}") - F.col(f"n_{b}") for a, b in pairs] + [F.col(f"n_{f}") for f in folded],
        **{k: [F.col(f"{k}_{a}").bitwiseXOR(F.col(f"{k}_{b}")) for a, b in pairs] + [F.col(f"{k}_{f}") for f in folded] for k in "xc"},
    }
    rows = cells.select("*", F.explode(F.array(*map(F.lit, range(len(parts))))).alias("which"))
    state = rows.select(
        *_KEY, choice(parts).alias("part"), F.when(which < len(pairs), F.col("cell")).otherwise(small_cell).alias("cell"),
        *[choice(values).alias(k) for k, values in differ.items()],
    )
    return _summed(state)


def _summed(state: DataFrame) -> DataFrame:
    """Cells that got several entries, added up; empty cells go."""
    full = (F.col("n") != 0) | (F.col("x") != 0) | (F.col("c") != 0)
    return state.groupBy(*_STATE).agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("c").alias("c")).where(full)


def peeled(state: DataFrame, steps: int = STEPS, tell: bool = True) -> DataFrame:
    """The state after so many steps: entries of the fourth row are digests (in `cell`) that the first (n = 1) or
    the second version (n = -1) of the pair has alone; other entries of a pair are what could not be peeled.
    Without `tell` the digests are only counted: the fourth row has a single entry with their number."""
    x, c, n, part = (F.col(k) for k in ("x", "c", "n", "part"))
    bits = F.shiftright("part", 3)
    zero, entry = F.lit(0).cast("bigint"), F.col("entry")
    for step in range(steps):
        row = step % 3
        first, second = sorted({0, 1, 2} - {row})
        alone = (part >= 0) & (part.bitwiseAND(F.lit(3)) == row) & (F.abs(n) == 1) & (c == _check(x))
        # A cell that holds one digest gives three entries: the digest (0), and what takes it out of its other cells.
        rows = state.select("*", F.explode(F.when(alone, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(3)))).alias("entry"))
        other = F.when(entry == 1, first).otherwise(second)
        state = _summed(
            rows.select(
                *_KEY,
                F.when(entry == 3, part).otherwise(part - row + F.when(entry == 0, _PEELED).otherwise(other)).alias("part"),
                F.when(entry == 3, F.col("cell")).when(entry == 0, x if tell else zero).otherwise(_cell(x, other, bits)).alias("cell"),
                F.when(entry == 3, n).when(entry == 0, n if tell else zero + 1).otherwise(-n).alias("n"),
                *[F.when(entry == 0, zero).otherwise(v).alias(name) for name, v in (("x", x), ("c", c))],
            )
        )
    return state


def differences(state: DataFrame) -> DataFrame:
    """(k1, k2, pair, digest, side) of a peeled state: the digests that one version of a pair has alone."""
    found = (F.col("part") >= 0) & (F.col("part").bitwiseAND(F.lit(3)) == _PEELED)
    return state.where(found).select(*_KEY, F.shiftright(F.col("part"), 2).bitwiseAND(F.lit(1)).alias("pair"), F.col("cell").alias("digest"), F.col("n").cast("int").alias("side"))


def _outcome(state: DataFrame, pairs: int, folded: int) -> DataFrame:
    """(k1, k2, found_i, left_i, print_j) of a state peeled without `tell`: digests recovered and cells left of each
    pair, folded sketches as text."""
    peeled_row = F.col("part").bitwiseAND(F.lit(3)) == _PEELED
    pair = F.shiftright(F.col("part"), 2).bitwiseAND(F.lit(1))
    kind = F.when(F.col("part") < 0, F.col("part")).otherwise(pair * 2 + F.when(peeled_row, 0).otherwise(1))
    cell = F.when(F.col("part") < 0, F.col("cell")).otherwise(F.lit(0).cast("bigint"))
    few = state.groupBy(*_KEY, kind.alias("kind"), cell.alias("cell")).agg(
        F.sum(F.when(peeled_row, F.col("n")).otherwise(1)).alias("m"), F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("c").alias("c")
    )
    counts = [F.sum(F.when(F.col("kind") == 2 * i + j, F.col("m")).otherwise(0)).alias(f"{name}_{i}") for i in range(pairs) for j, name in enumerate(("found", "left"))]
    text = F.concat_ws(":", F.lpad(F.hex("cell"), 2, "0"), F.hex("n"), F.hex("x"), F.hex("c"))
    prints = [F.array_join(F.array_sort(F.collect_list(F.when(F.col("kind") == -1 - j, text))), " ").alias(f"print_{j}") for j in range(folded)]
    return few.groupBy(*_KEY).agg(*counts, *prints)


def _attempt(docs: DataFrame, order: DataFrame, attempt: int) -> DataFrame:
    """Fingerprints and likenesses of the documents in `order`; `open` marks those whose sketches did not peel."""
    texts = with_digests(with_digests(versions(docs, order), "text", "d_text"), "edited", "d_edited")
    cells = sketches(texts, ["d_text", "d_edited", "d_next"], attempt)
    state = subtracted(cells, [("d_text", "d_edited"), ("d_text", "d_next")], ["d_text", "d_edited"])
    found = _outcome(peeled(state, tell=False), 2, 2)
    sizes = [F.size(f"d_{v}").alias(f"s_{v}") for v in ("text", "edited", "next")]
    own = texts.select(*_KEY, F.sha2("edited", 256).alias("edited_sha256"), *sizes).join(order.select("doc_id", *_KEY, "n_chars", "copies"), _KEY)
    joined = own.join(found, _KEY, "left").fillna({"found_0": 0, "left_0": 0, "found_1": 0, "left_1": 0, "print_0": "", "print_1": ""})

    def likeness(i: int, other: str) -> Column:
        both = F.col("s_text") + F.col(f"s_{other}")
        return F.when(both == 0, F.lit(1.0)).otherwise(1.0 - F.col(f"found_{i}") / both)

    return joined.select(
        "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"), "edited_sha256", F.col("print_0").alias("fingerprint"),
        F.col("print_1").alias("edited_fingerprint"), likeness(0, "edited").alias("near_edited"), likeness(1, "next").alias("near_next"),
        "copies", *_KEY, ((F.col("left_0") > 0) | (F.col("left_1") > 0)).alias("open"),
    )


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last half replaced by the beginning of the next document (descending doc_id, null ids
    last; rows that share an id in a fixed order; after the last comes the first; a single document is its own next). The
    likeness of two texts is 1 minus the share of their digests that peeling finds on one side alone.

    Null texts are empty: such a text has an empty fingerprint, the likeness of two empty texts is 1. Equal texts
    have equal fingerprints. Rows that repeat id and text are one document and give equal rows. Other columns
    are ignored.
    """
    order = successors(docs)
    done: list[DataFrame] = []
    spent, attempt = [order], 0
    while True:
        made = store(_attempt(docs, order, attempt), f"fingerprints{attempt}")
        done.append(made.where("not open"))
        open_keys = store(made.where("open").select(*_KEY), "open_keys")
        spent.append(open_keys)
        count = open_keys.count()
        if not count:
            break
        # The sketches of these pairs are made anew, with twice the cells.
        open_keys = F.broadcast(open_keys) if count <= BROADCAST_KEYS else open_keys
        order = store(order.join(open_keys, _KEY, "left_semi"), "open_order")
        spent.append(order)
        needed = order.select(*_KEY).union(order.select("n1", "n2")).distinct()
        docs = with_key(docs).join(small(needed, BROADCAST_KEYS), _KEY, "left_semi").select("doc_id", "text")
        attempt += 1
    discard(*spent)
    rows = functools.reduce(DataFrame.unionByName, done)
    again = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_copy")
    return rows.select("*", again).drop("copies", "open", "_copy", *_KEY)
