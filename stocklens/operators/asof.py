"""As-of joins: for each row of one side, the row of the other that held at its time.

No window ever sees a whole key. Both sides are united and range partitioned on (key, time), so a key that holds a
third of all rows spreads over many chunks. Inside a chunk the last row of the other side is carried forward, and
each chunk gets one carry: what the chunks before it last saw of the key it begins with. There is one carry row
per chunk, a number bounded by the shuffle partitions.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocklens.functions.scalar import KEYS
from stocklens.sources.scratch import materialize, partitions

_CHUNK, _TIME, _SIDE, _HELD, _TIE = "_chunk", "_time", "_side", "_held", "_tie"


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    columns: Sequence[str] | None = None,
    keys: Sequence[str] = KEYS,
    tie_by: Sequence[str] = (),
    direction: str = "backward",
    inclusive: bool = True,
    prefix: str = "",
) -> DataFrame:
    """``left`` with ``columns`` of the newest row of ``right`` with the same keys at or before ``left_time``.

    ``direction="forward"`` takes the oldest row at or after it, ``inclusive=False`` leaves equal times out.
    Every left row stays, once: without a match, with a null key or a null time, the columns are null. Right rows
    with a null key or time match nothing. Of several right rows of one key and time the greatest by
    ``tie_by`` counts, then by all of ``columns`` (nulls are smallest), so the result depends on no order of rows. The
    time may be any type that can be ordered, not only a date; both sides need the same. ``prefix`` is put
    before the names of the columns taken.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"unknown direction: {direction}")
    keys = list(keys)
    columns = [c for c in right.columns if c not in keys] if columns is None else list(columns)
    taken = [*dict.fromkeys([*columns, *tie_by])]
    held = F.struct(*[F.col(c).alias(c) for c in columns])
    present = F.lit(True)
    for k in (*keys, right_time):
        present = present & F.col(k).isNotNull()
    # Rows that hold sort before the rows that ask for them; those of an equal time after them if they do not count.
    first, last = (0, 1) if inclusive else (1, 0)
    kind = left.schema[left_time].dataType
    holds = right.where(present).select(
        *keys, F.col(right_time).cast(kind).alias(_TIME), F.lit(first).alias(_SIDE),
        F.struct(*[F.col(c) for c in (*tie_by, *columns)]).alias(_TIE), held.alias(_HELD), F.lit(None).cast(left.schema).alias("_row"),
    )
    blank = lambda name: F.lit(None).cast(holds.schema[name].dataType).alias(name)
    asks = left.select(*keys, F.col(left_time).alias(_TIME), F.lit(last).alias(_SIDE), blank(_TIE), blank(_HELD), F.struct(*left.columns).alias("_row"))
    both = holds.unionByName(asks)
    forward = direction == "forward"
    # Times of the other direction run backwards; of equal times the greatest tie comes last in either.
    order = [F.col(_TIME).desc_nulls_first() if forward else F.col(_TIME).asc_nulls_first(), F.col(_SIDE).asc(), F.col(_TIE).asc_nulls_first()]
    spread = F.xxhash64(*[F.col(f"_row.`{c}`") for c in left.columns])
    ranged = both.repartitionByRange(*[F.col(k).asc() for k in keys], *order, spread.asc())
    ranged = materialize(ranged.withColumn(_CHUNK, F.spark_partition_id()), "asof")
    frame = Window.partitionBy(_CHUNK, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = ranged.select("*", F.last(_HELD, ignorenulls=True).over(frame).alias("_seen")).where("_row is not null")
    carry = _carries(ranged, keys, forward)
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in (_CHUNK, *keys)]
    found = F.coalesce(F.col("r._seen"), F.col("c._carry"))
    joined = carried.alias("r").join(F.broadcast(carry).alias("c"), same, "left")
    return joined.select("r._row.*", *[found.getField(c).alias(f"{prefix}{c}") for c in columns])


def asof_by_key(
    left: DataFrame, right: DataFrame, left_time: str, right_time: str, columns: Sequence[str], keys: Sequence[str] = KEYS
) -> DataFrame:
    """What ``asof_join`` gives backward and inclusive, for keys that have few rows each: one window over a key's rows.

    Rows of ``left`` are moved once, or not at all if both sides lie by the first key; nothing is written. Rows with
    a null key stay out of the window. Rows of one key and time on the right are reduced before they travel.
    """
    keys = list(keys)
    present = functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    kind = left.schema[left_time].dataType
    held = F.max(F.struct(*[F.col(c).alias(c) for c in columns])).alias(_HELD)
    holds = right.where(present & F.col(right_time).isNotNull()).groupBy(*keys, F.col(right_time).cast(kind).alias(_TIME)).agg(held)
    named = {f"_row_{c}": c for c in left.columns if c not in keys}
    asks = left.where(present).select(
        *keys, F.col(left_time).alias(_TIME), F.lit(1).alias(_SIDE), F.lit(None).cast(holds.schema[_HELD].dataType).alias(_HELD),
        *[F.col(c).alias(r) for r, c in named.items()],
    )
    blank = [F.lit(None).cast(left.schema[c].dataType).alias(r) for r, c in named.items()]
    holds = holds.repartition(partitions(left.sparkSession), keys[0]).select(*keys, _TIME, F.lit(0).alias(_SIDE), _HELD, *blank)
    frame = Window.partitionBy(*keys).orderBy(F.col(_TIME).asc_nulls_first(), _SIDE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = asks.unionByName(holds).withColumn("_seen", F.last(_HELD, ignorenulls=True).over(frame)).where(F.col(_SIDE) == 1)
    own = [F.col(c) if c in keys else F.col(f"_row_{c}").alias(c) for c in left.columns]
    found = seen.select(*own, *[F.col("_seen").getField(c).alias(c) for c in columns])
    none = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in columns]
    return found.unionByName(left.where(~present).select(*left.columns, *none))


def _carries(ranged: DataFrame, keys: list[str], forward: bool) -> DataFrame:
    """(chunk, keys, carry): what was last held of the first key of each chunk in the chunks before it.

    Chunks are contiguous in key order, so an earlier chunk can only continue into a key that ends it: its last
    key and the last row held of that key are all that is needed of it."""
    group = F.struct(*keys)
    ends = ranged.groupBy(_CHUNK).agg(F.min(group).alias("first"), F.max(group).alias("last"))
    closing = ranged.where(F.col(_HELD).isNotNull()).join(F.broadcast(ends.select(_CHUNK, "last")), _CHUNK)
    closing = closing.where(group == F.col("last"))
    latest = closing.groupBy(_CHUNK, _TIME).agg(F.max_by(_HELD, _TIE).alias(_HELD))
    tops = latest.groupBy(_CHUNK).agg((F.min_by if forward else F.max_by)(_HELD, _TIME).alias("_top"))
    last = ends.join(tops, _CHUNK, "left").select(_CHUNK, F.col("last").alias("g"), F.lit(False).alias("probe"), "_top")
    probes = ends.select(_CHUNK, F.col("first").alias("g"), F.lit(True).alias("probe"), F.lit(None).cast(last.schema["_top"].dataType).alias("_top"))
    earlier = Window.partitionBy("g").orderBy(_CHUNK).rangeBetween(Window.unboundedPreceding, -1)
    seen = last.unionByName(probes).select(_CHUNK, "g", "probe", F.last("_top", ignorenulls=True).over(earlier).alias("_carry"))
    return seen.where("probe").select(_CHUNK, *[F.col(f"g.{k}").alias(k) for k in keys], "_carry")
