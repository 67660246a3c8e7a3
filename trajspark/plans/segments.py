"""Ordered work inside groups of any size.

A window over one burst is one Spark task. That is the best plan while every burst fits a task, and it fails
when one burst holds a large share of all rows. ``lay_out`` counts the groups once (a pre-aggregated, bounded
result) and decides:

* no group above the limit: windows are partitioned by the group key, one shuffle;
* some groups above it: their rows are range-partitioned on (key, order), written once with their partition
  number as segment number, and windows are partitioned by (key, segment). What a window would have seen
  in earlier segments is carried over from a small table with one row per segment.

``with_prefix`` and ``with_strict_next`` give the same values either way, ties and null times included.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from trajspark import settings

SEGMENT = "_segment"


@dataclass(frozen=True)
class Laid:
    """Rows plus the way their groups are laid out."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    split: bool = False
    segments: int = 0
    n_groups: int | None = None

    @property
    def groups(self) -> list[str]:
        return [*self.keys, SEGMENT] if self.split else list(self.keys)

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.groups).orderBy(*self.order)

    def on(self, df: DataFrame) -> Laid:
        """The same layout over changed columns."""
        return replace(self, df=df)

    def rows(self) -> DataFrame:
        return self.df.drop(SEGMENT)

    def position(self) -> Column:
        """A comparable position of a row inside its group."""
        return F.struct(*self.order)

    def join_groups(self, table: DataFrame, rows: int | None = None) -> Laid:
        """Join a table with one row per key. Split rows meet it per segment, so no group gathers in one task."""
        if self.split:
            table = self.df.select(*self.groups).distinct().join(table, list(self.keys))
            rows = None
        return self.on(self.df.join(settings.broadcast_if(table, rows), self.groups, "left"))


@dataclass(frozen=True)
class Known:
    """What is known about the groups without counting them: rows of the largest one, and how many there are."""

    largest: int
    groups: int


def lay_out(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    within: Laid | None = None,
    count_on: DataFrame | None = None,
    at_most: DataFrame | None = None,
    known_rows: int | None = None,
    known: Known | None = None,
) -> Laid:
    """Choose a layout for ordered work on ``df``.

    ``order`` names non-null columns that give a total order inside a group. The groups are counted with one
    pre-aggregated job, unless something known makes that unnecessary:

    * ``within``: an earlier layout whose groups contain these groups; when it needed no split, nor do they;
    * ``known_rows``: the number of rows of ``df`` (or more); nothing is large when that is within the limit;
    * ``known``: stored sizes of the groups; nothing is counted while the largest is within the limit;
    * ``count_on``: a cheaper table with the same number of rows per group, counted instead of ``df``;
    * ``at_most``: a cheaper table with at least as many rows per group; while it has no large group, ``df`` is not
      counted, and otherwise ``df`` is written before, so that it is computed once.
    """
    keys, order = tuple(keys), tuple(order)
    spark = df.sparkSession
    limit = settings.hot_rows(spark)
    plain = Laid(df.drop(SEGMENT), keys, order)
    if (within is not None and not within.split) or (known_rows is not None and known_rows <= limit):
        return plain
    if known is not None and known.largest <= limit:
        return replace(plain, n_groups=known.groups)
    if at_most is not None:
        if _group_sizes(at_most, keys)[0] <= limit:
            return plain
        plain = plain.on(settings.write_through(plain.df, "rows"))
    df = plain.df
    counted = df if count_on is None else count_on

    largest, n_groups, total = _group_sizes(counted, keys)
    if largest <= limit:
        return replace(plain, n_groups=n_groups)
    if not keys:
        frozen, n = _freeze(df, keys, order, total, limit)
        return Laid(frozen, keys, order, True, n, n_groups)

    # at most one group in ``limit`` rows is large, however many rows there are
    sizes = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    hot = settings.write_through(sizes, "large-groups")
    found = hot.agg(F.count(F.lit(1)).alias("groups"), F.sum("_n").alias("rows")).first()
    names = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    names = settings.broadcast_if(names, found["groups"])
    large = df.join(names, same, "left_semi")
    small = df.join(names, same, "left_anti").withColumn(SEGMENT, F.lit(0))
    frozen, n = _freeze(large, keys, order, found["rows"], limit)
    return Laid(small.unionByName(frozen), keys, order, True, n + found["groups"], n_groups)


def _group_sizes(df: DataFrame, keys: tuple) -> tuple[int, int, int]:
    """Rows of the largest group, number of groups and of rows."""
    if not keys:
        n = df.count()
        return n, 1, n
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    row = sizes.agg(F.max("_n").alias("largest"), F.count("_n").alias("groups"), F.sum("_n").alias("rows")).first()
    return row["largest"] or 0, row["groups"], row["rows"] or 0


def _freeze(df: DataFrame, keys: tuple, order: tuple, rows: int, limit: int) -> tuple[DataFrame, int]:
    """Write ``df`` in ordered ranges of about half the limit, numbered from 1."""
    n = max(2, math.ceil(2 * rows / limit))
    ranged = df.repartitionByRange(n, *keys, *order).withColumn(SEGMENT, F.spark_partition_id() + 1)
    return settings.write_through(ranged, "segments"), n


# -- running values ---------------------------------------------------------------------------------------


class Prefix:
    """A value that depends on the rows up to a row: in its segment, per segment, across segments."""

    needs_edge = False

    def __init__(self, value: Column | None = None):
        self.value = value

    def local(self, w: WindowSpec) -> Column:
        raise NotImplementedError

    def part(self, position: Column) -> Column:
        raise NotImplementedError

    def carry(self, part: str, w: WindowSpec) -> Column:
        raise NotImplementedError

    def merge(self, local: Column, carried: Column, edge: Column) -> Column:
        raise NotImplementedError


def _before(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, -1)


class RowNumber(Prefix):
    """1-based position in the group."""

    def local(self, w):
        return F.row_number().over(w).cast("long")

    def part(self, position):
        return F.count(F.lit(1))

    def carry(self, part, w):
        return F.sum(part).over(_before(w))

    def merge(self, local, carried, edge):
        return local + F.coalesce(carried, F.lit(0))


class RunningSum(Prefix):
    """Sum of ``value`` up to and including the row."""

    def local(self, w):
        return F.sum(self.value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def part(self, position):
        return F.sum(self.value)

    def carry(self, part, w):
        return F.sum(part).over(_before(w))

    def merge(self, local, carried, edge):
        return F.coalesce(local + carried, local, carried)


class Previous(Prefix):
    """``value`` of the row before."""

    needs_edge = True

    def local(self, w):
        return F.lag(self.value).over(w)

    def part(self, position):
        return F.max_by(self.value, position)

    def carry(self, part, w):
        return F.lag(part).over(w)

    def merge(self, local, carried, edge):
        return F.when(edge, carried).otherwise(local)


class LastKnown(Prefix):
    """Last non-null ``value`` of the rows before."""

    def local(self, w):
        return F.last(self.value, ignorenulls=True).over(_before(w))

    def part(self, position):
        return F.max_by(self.value, F.when(self.value.isNotNull(), position))

    def carry(self, part, w):
        return F.last(part, ignorenulls=True).over(_before(w))

    def merge(self, local, carried, edge):
        return F.coalesce(local, carried)


class FirstRow(Prefix):
    """``value`` of the first row of the group, null or not."""

    def local(self, w):
        return F.first(self.value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def part(self, position):
        return F.min_by(self.value, position)

    def carry(self, part, w):
        return F.first(part).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def merge(self, local, carried, edge):
        return F.when(F.col(SEGMENT) > 0, carried).otherwise(local)


def with_prefix(laid: Laid, **columns: Prefix) -> Laid:
    """Add running values as columns."""
    w = laid.window()
    df = laid.df.withColumns({name: p.local(w) for name, p in columns.items()})
    if not laid.split:
        return laid.on(df)

    edge = any(p.needs_edge for p in columns.values())
    if edge:
        df = df.withColumn("_edge", F.row_number().over(w) == 1)
    split_rows = laid.df.filter(F.col(SEGMENT) > 0)
    parts = {f"_part_{name}": p.part(laid.position()) for name, p in columns.items()}
    across = Window.partitionBy(*laid.keys).orderBy(SEGMENT)
    carried = split_rows.groupBy(*laid.groups).agg(*[c.alias(n) for n, c in parts.items()]).select(
        *laid.groups, *[p.carry(f"_part_{name}", across).alias(f"_carried_{name}") for name, p in columns.items()]
    )
    df = laid.on(df).df.join(settings.broadcast_if(carried, laid.segments), laid.groups, "left")
    flag = F.col("_edge") if edge else F.lit(False)
    merged = {name: p.merge(F.col(name), F.col(f"_carried_{name}"), flag) for name, p in columns.items()}
    df = df.withColumns(merged).drop("_edge", *[f"_carried_{name}" for name in columns])
    return laid.on(df)


# -- strict successor -------------------------------------------------------------------------------------


def with_strict_next(laid: Laid, at: str, payload: Sequence[str], name: str = "_next") -> Laid:
    """Add the first row of the group whose ``at`` is strictly larger, as a struct of (at, *payload).

    ``payload`` starts with the tie-breaking id. Rows with a null ``at`` neither have nor are successors. The first
    order column of the layout is ``at`` or, for rows without it, a value after all others: rows tied on it share the first row of the
    next tie, which the last of them sees. All windows use the order that the rows are in already.
    """
    row = F.when(F.col(at).isNotNull(), F.struct(at, *payload))
    tie = Window.partitionBy(*laid.groups, laid.order[0])
    df = laid.df.withColumn("_ends", F.lead(at).over(laid.window()) > F.col(at))  # first, so that rows are shuffled by group alone
    df = df.withColumn("_tie", F.min(row).over(tie))
    df = df.withColumn("_after", F.when(F.col("_ends"), F.lead("_tie").over(laid.window())))
    df = df.withColumn(name, F.when(F.col(at).isNotNull(), F.max("_after").over(tie))).drop("_ends", "_tie", "_after")
    if not laid.split:
        return laid.on(df)

    # Beyond a segment, the successor of its latest time is either the first row of a later segment or, when
    # that segment begins inside the same tie, the first later row in it. Both are plain aggregates of the rows.
    timed = laid.df.filter((F.col(SEGMENT) > 0) & F.col(at).isNotNull())
    ends = timed.groupBy(*laid.groups).agg(F.min(row).alias("_first"), F.min(at).alias("_earliest"), F.max(at).alias("_latest"))
    later = timed.join(settings.broadcast_if(ends.select(*laid.groups, "_earliest"), laid.segments), laid.groups)
    later = later.filter(F.col(at) > F.col("_earliest")).groupBy(*laid.groups).agg(F.min(row).alias("_second"))
    ends = ends.join(later, laid.groups, "left")
    rows_in = ends.select(*laid.keys, F.lit(None).cast("int").alias(SEGMENT), F.explode(F.array("_first", "_second")).alias("_row"))
    rows_in = rows_in.filter(F.col("_row").isNotNull()).withColumn("_at", F.col(f"_row.{at}"))
    asks = ends.select(*laid.groups, F.lit(None).cast(rows_in.schema["_row"].dataType).alias("_row"), F.col("_latest").alias("_at"))
    w = Window.partitionBy(*laid.keys).orderBy(F.col("_at").desc()).rangeBetween(Window.unboundedPreceding, -1)
    carried = (
        rows_in.select(*laid.groups, "_row", "_at")
        .unionByName(asks)
        .withColumn("_carried", F.min("_row").over(w))
        .filter(F.col(SEGMENT).isNotNull())
        .select(*laid.groups, "_carried")
    )
    df = df.join(settings.broadcast_if(carried, laid.segments), laid.groups, "left")
    df = df.withColumn(name, F.when(F.col(at).isNotNull(), F.coalesce(name, "_carried"))).drop("_carried")
    return laid.on(df)
