"""Exact top-k by inner product with M-trees over parts of the vectors.

Vectors are integers, floor(256 x). Within a part, one coordinate sqrt(M^2 - |v|^2) is added
(M: the part's largest norm), which turns the order by inner product into the order by Euclidean distance, a
metric. A part's tree is a table of pages: entries with their distance to the page's routing
object, and, above the leaves, covering radii. The search visits pages best first and skips an entry
without computing its distance when the stored parent distance and the triangle inequality
rule it out. Scores are exact integers; bounds only ever prune with slack for rounding.

Every part meets every block of the stated queries; both are bounded, neither is sent whole to anyone.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocklens.llm.common import store

#: Vectors of a part, queries of a block (expected numbers: both are dealt by hash).
PART_ROWS, BLOCK_ROWS = 8_192, 512
PAGE = 128
SLACK = 1e-6

PAGES = "dim int, part int, node int, leaf boolean, n int, content binary, parent_distance binary, radius binary, child binary, vec_id binary, rid binary"


def usable(vectors: DataFrame) -> DataFrame:
    """(rid, vec_id, dim, v) of rows with an id and only finite components; stored."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select("vec_id", "embedding").where("vec_id is not null and embedding is not null and size(embedding) > 0").where(sound)
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    return store(rows.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("bigint").alias("vec_id"), F.size("embedding").alias("dim"), v.alias("v")), "vectors")


class _Builder:
    """Bulk load of one part: routing objects drawn from the part, entries to the nearest one."""

    def __init__(self, v: np.ndarray, vec_id: np.ndarray, rid: np.ndarray) -> None:
        norms = (v * v).sum(1)
        self.v, self.vec_id, self.rid = v, vec_id, rid
        self.x = np.hstack([v, np.sqrt(np.maximum(0, norms.max() - norms))[:, None]])
        self.pages: list[dict] = []
        self.random = np.random.default_rng(len(v))

    def page(self, own: np.ndarray, router: np.ndarray) -> tuple[int, float]:
        """Make the subtree of the entries `own`; its page number and covering radius."""
        number = len(self.pages)
        self.pages.append({})
        far = np.sqrt(((self.x[own] - router) ** 2).sum(1))
        if len(own) <= PAGE:
            made = {"leaf": True, "content": self.v[own], "parent_distance": far, "radius": np.zeros(len(own)), "child": np.zeros(len(own), np.int64), "vec_id": self.vec_id[own], "rid": self.rid[own]}
        else:
            fan = min(PAGE, -(-len(own) // (PAGE // 2)))
            routers = self.random.choice(own, fan, replace=False)
            square = (self.x[own] ** 2).sum(1)[:, None] - 2 * self.x[own] @ self.x[routers].T + (self.x[routers] ** 2).sum(1)
            nearest = square.argmin(1)
            if (nearest == nearest[0]).all():  # equal vectors: any even split is as good
                nearest = np.arange(len(own)) % fan
            routers, parts = zip(*[(r, own[nearest == i]) for i, r in enumerate(routers) if (nearest == i).any()], strict=True)
            routers = np.array(routers)
            children = [self.page(p, self.x[r]) for r, p in zip(routers, parts, strict=True)]
            none = np.zeros(len(routers), np.int64)
            to_router = np.sqrt(((self.x[routers] - router) ** 2).sum(1))
            made = {"leaf": False, "content": self.x[routers], "parent_distance": to_router, "radius": np.array([r for _, r in children]), "child": np.array([c for c, _ in children]), "vec_id": none, "rid": none}
        self.pages[number] = made
        return number, float(far.max())


def build_pages(vectors: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """The trees of all parts as a table of pages; page 0 is a part's root."""
    n_parts = max(1, -(-vectors.count() // part_rows))

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rid")
        made = _Builder(np.stack(rows["v"].to_numpy()).astype(float), rows["vec_id"].to_numpy(np.int64), rows["rid"].to_numpy(np.int64))
        made.page(np.arange(len(rows)), made.x.mean(0))
        root = made.x.mean(0)
        made.pages.append({"leaf": False, "content": root[None], "parent_distance": np.zeros(1), "radius": np.zeros(1), "child": np.zeros(1, np.int64), "vec_id": np.zeros(1, np.int64), "rid": np.zeros(1, np.int64)})
        out = [
            {"dim": key[0], "part": key[1], "node": i if i < len(made.pages) - 1 else -1, "leaf": p["leaf"], "n": len(p["parent_distance"])}
            | {c: np.ascontiguousarray(p[c]).tobytes() for c in ("content", "parent_distance", "radius", "child", "vec_id", "rid")}
            for i, p in enumerate(made.pages)
        ]
        return pd.DataFrame(out)

    dealt = vectors.withColumn("part", F.pmod(F.xxhash64("rid"), F.lit(n_parts)).cast("int"))
    return store(dealt.groupBy("dim", "part").applyInPandas(build, PAGES), "pages")


class Tree:
    """A part's pages, decoded."""

    def __init__(self, rows: pd.DataFrame) -> None:
        self.pages: dict[int, dict] = {}
        for r in rows.itertuples(index=False):
            own = {c: np.frombuffer(getattr(r, c), np.int64 if c in ("child", "vec_id", "rid") else np.float64) for c in ("parent_distance", "radius", "child", "vec_id", "rid")}
            own |= {"leaf": r.leaf, "content": np.frombuffer(r.content, np.float64).reshape(r.n, -1)}
            self.pages[r.node] = own
        self.root = self.pages.pop(-1)["content"][0]
        self.computed = 0

    def search(self, q: np.ndarray, own_rid: int, k: int) -> list[tuple[int, int, int]]:
        """The k best (-score, vec_id, rid) for the query, its own row left out."""
        dim = len(q)
        target = np.append(q, 0.0)
        # |target - x|^2 = |q|^2 + M^2 - 2 q.x, so a score bound is a distance bound.
        base = float(q @ q) + float(self._norm())
        best: list[tuple[int, int, int]] = []  # a max-heap of the worst kept, as negated triples
        limit = np.inf
        to_root = float(np.sqrt(((target - self.root) ** 2).sum()))
        queue: list[tuple[float, int, float]] = [(0.0, 0, to_root)]
        while queue:
            least, number, to_parent = heapq.heappop(queue)
            if least > limit:
                break
            page = self.pages[number]
            open_ = np.abs(to_parent - page["parent_distance"]) - page["radius"] <= limit
            if not open_.any():
                continue
            self.computed += int(open_.sum())
            if page["leaf"]:
                scores = page["content"][open_] @ q
                ids, rids = page["vec_id"][open_], page["rid"][open_]
                if len(best) == k:  # ties count: a smaller id may still enter
                    close = scores >= best[0][0]
                    scores, ids, rids = scores[close], ids[close], rids[close]
                for score, vec_id, rid in zip(scores.tolist(), ids.tolist(), rids.tolist(), strict=True):
                    if rid == own_rid:
                        continue
                    entry = (int(score), -vec_id, -rid)
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                if len(best) == k:
                    limit = np.sqrt(max(0.0, base - 2 * best[0][0])) * (1 + SLACK) + SLACK
            else:
                x = page["content"][open_]
                to = np.sqrt(((x - target[: dim + 1]) ** 2).sum(1))
                bound = np.maximum(0, to - page["radius"][open_])
                for b, child, d in zip(bound.tolist(), page["child"][open_].tolist(), to.tolist(), strict=True):
                    if b <= limit:
                        heapq.heappush(queue, (b, child, d))
        return best

    def _norm(self) -> float:
        if not hasattr(self, "_m"):
            self._m = max((p["content"] ** 2).sum(1).max() for p in self.pages.values() if p["leaf"])
        return self._m


def top_k(vectors: DataFrame, divisor: int = 50, k: int = 5, part_rows: int = PART_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per query (rows whose vec_id is divisible by `divisor`): query_id, rank, vec_id, score of its k best rows.

    Ties go to the smaller vec_id. Rows with a null id, or a vector that is null, empty or holds null or
    non-finite components, take no part; vectors of different lengths do not meet; a row
    repeating another is a candidate of its own, and a query of its own. Other columns are ignored.
    """
    rows = usable(vectors)
    pages = build_pages(rows, part_rows)
    queries = rows.where(F.pmod("vec_id", F.lit(divisor)) == 0)
    n_blocks = max(1, -(-queries.count() // block_rows))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("rid", F.lit(7)), F.lit(n_blocks)).cast("int"))
    parts = pages.where("node = -1").select(F.col("dim").alias("q_dim"), F.col("part").alias("q_part"))
    left = pages.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    right = queries.join(parts, F.col("dim") == F.col("q_dim")).select("q_dim", "q_part", F.col("block").alias("q_block"), "rid", "vec_id", "v")

    def search(found: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(found) and len(asked):
            tree = Tree(found)
            for rid, vec_id, v in zip(asked["rid"], asked["vec_id"], asked["v"], strict=True):
                out += [(rid, vec_id, s, -i, -r) for s, i, r in tree.search(np.asarray(v, float), rid, k)]
        return pd.DataFrame(out, columns=["q_rid", "query_id", "score", "vec_id", "rid"]).astype("int64")

    met = left.groupBy("dim", "part", "block").cogroup(right.groupBy("q_dim", "q_part", "q_block"))
    met = met.applyInPandas(search, "q_rid bigint, query_id bigint, score bigint, vec_id bigint, rid bigint")
    order = Window.partitionBy("q_rid").orderBy(F.desc("score"), "vec_id", "rid")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

