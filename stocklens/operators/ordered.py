"""Ordered computations that never funnel a group through one task.

* ``prefix_sum``  running sums over a global or per-group order
* ``row_rank``    0-based global position
* ``exact_quantiles``  linear-interpolated quantiles per group
* ``densify``     key x month matrix in long form
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocklens.sources.scratch import materialize, partitions

_CHUNK = "_chunk"


def prefix_sum(
    df: DataFrame,
    sums: Mapping[str, str | Column],
    order_by: Sequence[Column],
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Running sums in ``order_by`` order, restarted per group.

    ``sums`` maps each output column to the summed column or expression. The order
    must be total (add tie-breakers) for the result to be deterministic.

    Rows are range partitioned on (group, order), so a group or a tied value that
    holds a third of all rows still spreads over many chunks. Running sums are
    taken inside each chunk, and every chunk then adds one carry: the totals of
    the chunks before it. There is one carry row per chunk, a number bounded by
    the shuffle partition count, whatever the data size.
    """
    group_by = list(group_by)
    staged = df.select("*", *[_as_col(c).alias(f"_in_{out}") for out, c in sums.items()])
    ranged = materialize(
        staged.repartitionByRange(*[F.col(g).asc() for g in group_by], *order_by).withColumn(
            _CHUNK, F.spark_partition_id()
        ),
        "ranged",
    )
    frame = (
        Window.partitionBy(_CHUNK, *group_by)
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = ranged.select("*", *[F.sum(f"_in_{o}").over(frame).alias(f"_run_{o}") for o in sums])
    totals = ranged.groupBy(_CHUNK, *group_by).agg(*[F.sum(f"_in_{o}").alias(f"_t_{o}") for o in sums])
    carry = _grouped_carry(totals, list(sums), group_by) if group_by else _global_carry(totals, list(sums))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in (_CHUNK, *group_by)]
    joined = running.alias("r").join(F.broadcast(carry).alias("c"), same, "left")
    out = [
        (F.col(f"r._run_{o}") + F.coalesce(F.col(f"c._carry_{o}"), F.lit(0))).alias(o) for o in sums
    ]
    return joined.select(*[F.col(f"r.{c}") for c in df.columns], *out)


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _global_carry(totals: DataFrame, outs: list[str]) -> DataFrame:
    """Sum of all earlier chunks; one row per chunk."""
    before = Window.orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(_CHUNK, *[F.sum(f"_t_{o}").over(before).alias(f"_carry_{o}") for o in outs])


def _grouped_carry(totals: DataFrame, outs: list[str], group_by: list[str]) -> DataFrame:
    """Carry into the first group of each chunk.

    Chunks are contiguous in group order, so only the first group of a chunk can
    continue from earlier chunks, and there it was the last group.
    """
    group = F.struct(*group_by)
    edges = totals.groupBy(_CHUNK).agg(
        F.min(group).alias("first"),
        F.max(group).alias("last"),
        *[F.max_by(f"_t_{o}", group).alias(f"_t_{o}") for o in outs],
    )
    ends = edges.select(F.col("last").alias("g"), _CHUNK, F.lit(False).alias("probe"), *[f"_t_{o}" for o in outs])
    probes = edges.select(
        F.col("first").alias("g"),
        _CHUNK,
        F.lit(True).alias("probe"),
        *[F.lit(None).cast(edges.schema[f"_t_{o}"].dataType).alias(f"_t_{o}") for o in outs],
    )
    earlier = Window.partitionBy("g").orderBy(_CHUNK).rangeBetween(Window.unboundedPreceding, -1)
    summed = ends.unionByName(probes).select(
        "g", _CHUNK, "probe", *[F.sum(f"_t_{o}").over(earlier).alias(f"_carry_{o}") for o in outs]
    )
    return summed.where("probe").select(
        _CHUNK, *[F.col(f"g.{g}").alias(g) for g in group_by], *[f"_carry_{o}" for o in outs]
    )


def row_rank(df: DataFrame, order_by: Sequence[Column], out: str = "row_rank") -> DataFrame:
    """0-based position of each row in a global order."""
    ranked = prefix_sum(df, {out: F.lit(1).cast("bigint")}, order_by)
    return ranked.withColumn(out, F.col(out) - 1)


#: Buckets for each doubling of a value; a bucket is 1.1 % wide.
BUCKETS = 64


def magnitude_bucket(value: str) -> Column:
    """An integer that never falls as the value grows: sign and rounded logarithm of the magnitude."""
    v = F.col(value).cast("double")
    size = 100_000 + F.floor(F.least(F.greatest(F.log2(F.abs(v)), F.lit(-1_100.0)), F.lit(1_100.0)) * BUCKETS)
    whole = F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0))
    return F.when(F.isnan(v), F.lit(1_000_000)).otherwise(whole).cast("bigint")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    weight: str | None = None,
) -> DataFrame:
    """Exact quantiles per key with linear interpolation between neighbours.

    A histogram of magnitude buckets, which is a sketch that adds up, brackets each quantile: running counts over
    a key's few buckets name the bucket that holds it and how many values lie below. The values of those buckets
    alone are then ranked. Rows are reduced to (key, value) counts and shuffled once, by key and bucket, so a hot key
    costs its distinct values and spreads over its buckets; nothing is written or range partitioned. Null keys are
    a key, null values none. ``weight`` names a repeat count when ``df`` is a histogram already.
    """
    keys = list(keys)
    repeats = F.sum(weight) if weight else F.count(F.lit(1))
    rows = df.where(F.col(value).isNotNull()).withColumn("_bucket", magnitude_bucket(value))
    histogram = rows.groupBy(*keys, "_bucket", value).agg(repeats.alias("_n"))
    sketch = histogram.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_n"))
    key = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    upto = key.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sketch.select(*keys, "_bucket", "_n", F.sum("_n").over(upto).alias("_upto"), F.sum("_n").over(key).alias("_size"))
    position = {out: (F.col("_size") - 1) * F.lit(float(p)) for out, p in probs.items()}
    ranks = [r for at in position.values() for r in (F.floor(at), F.ceil(at))]
    below = F.col("_upto") - F.col("_n")
    needed = functools.reduce(lambda x, y: x | y, [(below <= r) & (F.col("_upto") > r) for r in ranks])
    brackets = placed.where(needed).select(*keys, "_bucket", below.alias("_below"), "_size")
    same = [F.col(f"h.{k}").eqNullSafe(F.col(f"b.{k}")) for k in (*keys, "_bucket")]
    inside = histogram.alias("h").join(brackets.alias("b"), same).select("h.*", "b._below", "b._size")
    ordered = Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inside.withColumn("_upto", F.col("_below") + F.sum("_n").over(ordered))
    picks = []
    for out, at in position.items():
        picks += [
            F.min(F.when(F.col("_upto") > F.floor(at), F.col(value))).cast("double").alias(f"_lo_{out}"),
            F.min(F.when(F.col("_upto") > F.ceil(at), F.col(value))).cast("double").alias(f"_hi_{out}"),
            F.max(at - F.floor(at)).alias(f"_w_{out}"),
        ]
    between = lambda o: F.col(f"_lo_{o}") + (F.col(f"_hi_{o}") - F.col(f"_lo_{o}")) * F.col(f"_w_{o}")
    return ranked.groupBy(*keys).agg(*picks).select(*keys, *[between(o).alias(o) for o in probs])


def densify(df: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    """Fill every (key, observed period) pair, with 0 where the key has no row.

    The observed periods are one small sorted array (months, not rows), taken as a scalar subquery. The rows of a key
    are sorted by period, and each brings the periods between the row before it and itself, the last one also those
    after it. So only the rows there are get shuffled (once, by key) and sorted; the zeros arise at the end and are held
    nowhere. Give it sums by period, which are few a key, not facts.
    """
    keys = list(keys)
    summed = df.select(*keys, period, value).repartition(partitions(df.sparkSession), *keys).groupBy(*keys, period).agg(F.sum(value).alias(value))
    kind = summed.select(F.sum(value)).schema[0].dataType
    periods = df.select(period).distinct().select(F.array_sort(F.collect_list(period))).scalar()
    by_period = Window.partitionBy(*keys).orderBy(period)  # one row a period; a null period comes first, at place 0
    placed = summed.withColumns({"_all": periods, "_at": F.coalesce(F.array_position(periods, F.col(period)), F.lit(0)).cast("int")})
    seen = placed.withColumns({
        "_before": F.coalesce(F.lag("_at").over(by_period), F.lit(0)),
        "_last": F.lead("_at").over(by_period).isNull(),
    })
    gap = F.slice("_all", F.col("_before") + 1, F.greatest(F.col("_at") - F.col("_before") - 1, F.lit(0)))
    rest = F.slice("_all", F.col("_at") + 1, F.when(F.col("_last"), F.size("_all") - F.col("_at")).otherwise(0))
    filled = seen.select(*keys, F.col(period).alias("_own"), value, F.explode(F.concat(gap, F.array(period), rest)).alias(period))
    own = F.when(F.col(period).isNull(), F.col(value)).otherwise(F.coalesce(F.when(F.col(period) == F.col("_own"), F.col(value)), F.lit(0)))
    return filled.select(*keys, period, own.cast(kind).alias(value))
