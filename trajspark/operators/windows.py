"""Time windows over a step view."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajspark import settings
from trajspark.functions import planar
from trajspark.functions.times import seconds, wall_time
from trajspark.operators.ids import with_step_ids
from trajspark.operators.lines import step_lines
from trajspark.operators.parameters import shape
from trajspark.operators.steps import BURST, LAST, TYPE_II, build_steps
from trajspark.plans.segments import Known, Laid, LastKnown, Previous, RunningSum, lay_out, with_prefix
from trajspark.settings import write_through

STEP_COLUMNS = ("step_id", "step_geom", "date", "dx", "dy", "dist", "dt", "abs_angle", "rel_angle")
NAME_COLUMNS = ("animal_name", "burst_name", "pgtraj_name")


def in_window(view: DataFrame, time: datetime, interval: timedelta) -> DataFrame:
    """Steps with time <= date < time + interval. The bounds are literals, so they reach a Parquet scan."""
    return view.filter((F.col("date") >= F.lit(time)) & (F.col("date") < F.lit(time + interval)))


def window_steps(view: DataFrame, time: datetime, interval: timedelta, info_cols=()) -> DataFrame:
    """All step columns of the window, with the named info columns; steps without a line are left out."""
    found = in_window(view, time, interval).filter(F.col("step_geom").isNotNull())
    return found.select(*STEP_COLUMNS, *info_cols, *NAME_COLUMNS)


def window_lines(
    view: DataFrame, time: datetime, interval: timedelta, at_most: DataFrame | None = None, known: Known | None = None
) -> DataFrame:
    """One line per burst and animal inside the window."""
    return step_lines(in_window(view, time, interval), ["pgtraj_name", "burst_name", "animal_name"], at_most=at_most, known=known)


def page(view: DataFrame, start: datetime, interval: timedelta, increment: timedelta, number: int, info_cols=()) -> DataFrame:
    """The window ``number`` increments after (negative: before) ``start``. A closed window is an error."""
    if interval <= timedelta(0):
        raise ValueError("the window must be open: interval > 0")
    return window_steps(view, start + number * increment, interval, info_cols)


def micros_of(time: datetime) -> int:
    return round((time - datetime(1970, 1, 1)) / timedelta(microseconds=1))


def _floored(value: Column, by: int) -> Column:
    return ((value - F.pmod(value, F.lit(by))) / by).cast("long")


def sliding_windows(view: DataFrame, start: datetime, width: timedelta, slide: timedelta) -> DataFrame:
    """Each step once per page it falls in; page k covers [start + k*slide, start + k*slide + width), k >= 0.

    Row-local: a step meets at most ceil(width / slide) pages. Adds page, page_start and page_end.
    """
    if width <= timedelta(0) or slide <= timedelta(0):
        raise ValueError("width and slide must be positive")
    origin = micros_of(start)
    wide, stride = round(width / timedelta(microseconds=1)), round(slide / timedelta(microseconds=1))
    since = F.col("us") - origin
    first = F.greatest(_floored(since - wide, stride) + 1, F.lit(0).cast("long"))
    pages = F.sequence(first, _floored(since, stride))
    df = view.filter((since >= 0) & (_floored(since, stride) >= first)).withColumn("page", F.explode(pages))
    begin = F.col("page") * stride + origin
    return df.withColumns({"page_start": wall_time(begin), "page_end": wall_time(begin + wide)})


def pages_summary(view: DataFrame, start: datetime, width: timedelta, slide: timedelta) -> DataFrame:
    """Steps, bursts and way per page and pgtraj; pages without steps are left out.

    No step is repeated for the pages it is in. A step is in the pages from its first to its last one, so it counts +1 where they begin and -1
    after they end; these changes are summed per (pgtraj, page) before they are shuffled on, and a page's value is their running sum. A burst's
    pages are runs of pages with steps; runs that touch are merged first, so each burst counts once. Rows thus don't grow with width / slide. Ways are
    summed as decimals, so that what is added is taken away again exactly.
    """
    if width <= timedelta(0) or slide <= timedelta(0):
        raise ValueError("width and slide must be positive")
    origin, wide, stride = micros_of(start), round(width / timedelta(microseconds=1)), round(slide / timedelta(microseconds=1))
    since = F.col("us") - origin
    first, last = F.greatest(_floored(since - wide, stride) + 1, F.lit(0).cast("long")), _floored(since, stride)
    steps = view.filter((since >= 0) & (last >= first)).select(
        "pgtraj_name", "burst_name", first.alias("first"), last.alias("last"), F.col("dist").cast("decimal(38, 12)").alias("dist"))
    # steps that share their pages are one row
    runs = steps.groupBy("pgtraj_name", "burst_name", "first", "last").agg(
        F.count(F.lit(1)).alias("n"), F.sum("dist").cast("decimal(38, 12)").alias("dist"), F.count("dist").alias("measured"))
    laid = lay_out(runs, ("pgtraj_name", "burst_name"), ("first", "last"), at_most=steps.select("pgtraj_name", "burst_name"))
    laid = with_prefix(laid, _reach=Previous(F.col("last")))  # first and last rise together, so the row before reaches furthest
    free = laid.rows().withColumn("fresh", F.greatest(F.col("first"), F.coalesce(F.col("_reach") + 1, F.lit(0).cast("long"))))
    changes = free.select(
        "pgtraj_name",
        F.explode(
            F.array(
                _change(F.col("first"), F.col("n"), F.col("dist"), F.col("measured"), F.lit(0)),
                _change(F.col("last") + 1, -F.col("n"), -F.col("dist"), -F.col("measured"), F.lit(0)),
                _change(F.col("fresh"), F.lit(0), F.lit(None), F.lit(0), F.when(F.col("fresh") <= F.col("last"), 1).otherwise(0)),
                _change(F.col("last") + 1, F.lit(0), F.lit(None), F.lit(0), F.when(F.col("fresh") <= F.col("last"), -1).otherwise(0)),
            )
        ).alias("c"),
    )
    sums = {c: F.sum(f"c.{c}") for c in ("n", "measured", "bursts")}
    at = changes.groupBy("pgtraj_name", F.col("c.page").alias("page")).agg(
        *[v.alias(c) for c, v in sums.items()], F.coalesce(F.sum("c.dist"), F.lit(0)).cast("decimal(38, 12)").alias("dist"))
    laid = lay_out(at, ("pgtraj_name",), ("page",), at_most=steps.select("pgtraj_name"))
    running = {c: RunningSum(F.col(c)) for c in ("n", "measured", "bursts", "dist")}
    laid = with_prefix(laid.on(laid.df), **{f"_{c}": p for c, p in running.items()}, _before=Previous(F.col("page")))
    # what holds from one change to the next holds for all pages between; the values before a change are its running sum less itself
    held = laid.rows().filter(F.col("_before").isNotNull() & (F.col("_n") - F.col("n") > 0))
    pages = held.withColumn("page", F.explode(F.sequence("_before", F.col("page") - 1)))
    begin = F.col("page") * stride + origin
    dist = F.when(F.col("_measured") - F.col("measured") > 0, (F.col("_dist") - F.col("dist")).cast("double"))
    return pages.select(
        "pgtraj_name", "page", wall_time(begin).alias("page_start"), wall_time(begin + wide).alias("page_end"),
        (F.col("_n") - F.col("n")).alias("num_steps"), (F.col("_bursts") - F.col("bursts")).alias("num_bursts"), dist.alias("dist"))


def _change(page: Column, n: Column, dist: Column, measured: Column, bursts: Column) -> Column:
    return F.struct(
        page.cast("long").alias("page"), n.cast("long").alias("n"), dist.cast("decimal(38, 12)").alias("dist"),
        measured.cast("long").alias("measured"), bursts.cast("long").alias("bursts"))


# -- windows over relocations ------------------------------------------------------------------------------------


def relocations_window(relocations: DataFrame, time: datetime, interval: timedelta) -> DataFrame:
    """Steps with all parameters and ids that start inside a window, from relocations with times; ordered work holds the window only.

    A step needs more than the rows inside: the fix after it, the step before it, the burst's first fix and the number of fixes before. Per burst
    these are plain aggregates: the last fix before the window, the first one after it, the first of all, and counts. Rows inside and those
    two neighbours are ordered, nothing else. Where the turn needs a moving step from before the window, its direction is looked up
    (``_moving_before``).
    """
    low, high = micros_of(time), micros_of(time + interval)
    us, fix = F.col("us"), F.struct("us", "rid", "x", "y")
    inside = (us >= low) & (us < high)
    every = relocations.groupBy(*BURST).agg(
        F.count(F.lit(1)).alias("burst_steps"), F.min("animal_name").alias("animal_name"), F.count_if(us < low).alias("_earlier_rows"), F.count_if(inside).alias("_inside"),
        F.max(F.when(us < low, fix)).alias("_last"), F.min(F.when(inside, fix)).alias("_enter"),
        F.min(F.when(us >= high, fix)).alias("_after"),
        F.min(F.struct(F.coalesce("us", F.lit(LAST)).alias("us"), "rid", "x", "y")).alias("_first"),
    )
    every = write_through(every, "window-bursts")
    bursts = every.filter("_inside > 0")
    size = bursts.agg(F.count(F.lit(1)).alias("groups"), F.max("_inside").alias("largest")).first()
    known = Known((size["largest"] or 0) + 2, size["groups"])
    columns = ["pgtraj_name", "burst_name", "us", "rid", "x", "y"]
    edges = bursts.select(*BURST, F.explode(F.array("_last", "_after")).alias("_e")).filter("_e is not null").select(*BURST, "_e.*")
    rows = relocations.filter(inside).select(*columns).unionByName(edges.select(*columns))
    laid = build_steps(rows, TYPE_II, numbered=True, known=known)
    laid = laid.on(shape(laid.df))
    laid = with_prefix(laid, _before=Previous(F.struct("dist", "abs_angle")), _moving=LastKnown(F.col("abs_angle")))
    told = bursts.select(
        *BURST, "animal_name", "_first", (F.col("_earlier_rows") - F.when(F.col("_last").isNull(), 0).otherwise(1)).alias("_skipped"))
    laid = laid.join_groups(told, size["groups"])
    steps = write_through(laid.rows().filter(inside), "window-steps")
    still = F.col("_before.dist") < planar.STATIONARY
    needy = steps.filter(still & F.col("_moving").isNull() & F.col("abs_angle").isNotNull()).select(*BURST).distinct()
    moving = _moving_before(relocations.filter(us < low), low, write_through(needy.join(bursts, list(BURST)), "window-still"))
    steps = steps.join(moving, list(BURST), "left")
    turn = F.col("abs_angle") - F.when(still, F.coalesce("_moving", "_carried")).otherwise(F.col("_before.abs_angle"))
    from_x, from_y = F.col("x") - F.col("_first.x"), F.col("y") - F.col("_first.y")
    steps = steps.withColumns(
        {
            "dt": seconds(F.col("dt_us")), "r2n": from_x * from_x + from_y * from_y, "rel_angle": planar.wrap(turn),
            "seq": F.col("seq") + F.col("_skipped"), "seq2": F.col("seq2") + F.col("_skipped"),
        }
    ).drop("_before", "_moving", "_carried", "_first", "_skipped")
    numbered = Laid(steps, BURST, ("us", "rid"), n_groups=every.count())
    return with_step_ids(numbered, every.select(*BURST, "burst_steps")).rows()


def _moving_before(earlier: DataFrame, low: int, bursts: DataFrame) -> DataFrame:
    """(burst, _carried): the direction of the last moving step that starts before the window, for the given bursts.

    Almost always all fixes from some fix on are at the last fix's place: then the step from the last fix elsewhere to that place is the one, and
    finding it takes a maximum. A burst where that fix is unknown, tied in time or no step away is worked through in order.
    """
    n = bursts.count()
    near = earlier.join(settings.broadcast_if(bursts.select(*BURST, "_last"), n), list(BURST))
    known = F.col("x").isNotNull() & F.col("y").isNotNull()
    elsewhere = ~known | (F.col("x") != F.col("_last.x")) | (F.col("y") != F.col("_last.y"))
    found = near.groupBy(*BURST).agg(F.max(F.when(elsewhere, F.struct("us", "rid", "x", "y"))).alias("_from"), F.first("_last").alias("_last"))
    dx, dy = F.col("_last.x") - F.col("_from.x"), F.col("_last.y") - F.col("_from.y")
    far = planar.length(dx, dy) >= planar.STATIONARY
    clear = F.col("_from").isNull() | F.coalesce(far & (F.col("_from.us") < F.col("_last.us")), F.lit(False))
    found = write_through(found.select(*BURST, clear.alias("_clear"), F.when(far, F.atan2(dy, dx)).alias("_carried")), "window-moving")
    rest = found.filter(~F.col("_clear")).select(*BURST)
    columns = ["pgtraj_name", "burst_name", "us", "rid", "x", "y"]
    several = earlier.join(settings.broadcast_if(rest, n), list(BURST), "left_semi").select(*columns)
    entered = bursts.join(rest, list(BURST), "left_semi").select(*BURST, "_enter.*").select(*columns)
    steps = shape(build_steps(several.unionByName(entered), TYPE_II).rows()).filter((F.col("us") < low) & F.col("abs_angle").isNotNull())
    ordered = steps.groupBy(*BURST).agg(F.max_by("abs_angle", F.struct("us", "rid")).alias("_carried"))
    return found.filter("_clear").select(*BURST, "_carried").unionByName(ordered)
