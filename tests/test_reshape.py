import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trajspark.operators import infolocs, lines, reshape, summary, windows
from trajspark.operators.infolocs import InfoType
from trajspark.operators.steps import build_steps, ordered

S = 1_000_000


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_missing_relocations_fill_the_grid(make):
    df = make([("a", 1, 0, 0.0, 0.0), ("a", 2, 11, 1.0, 0.0), ("a", 3, 39, 2.0, 0.0)])
    out = reshape.set_na(df, 0, 10 * S)
    assert rows(out, "rid", "us", "x") == sorted(
        [(1, 0, 0.0), (2, 11 * S, 1.0), (3, 39 * S, 2.0), (None, 20 * S, None), (None, 30 * S, None)], key=repr
    )
    with pytest.raises(ValueError, match="irregular"):
        reshape.set_na(df.unionByName(make([("a", 9, 55, 0.0, 0.0)])), 0, 10 * S, tolerance_us=2 * S)
    regular = reshape.set_t0(out, 0, 10 * S)
    assert [r[0] for r in rows(regular.orderBy("us"), "us")] == sorted([0, 10 * S, 20 * S, 30 * S, 40 * S], key=repr)
    assert summary.is_regular(reshape.recompute(regular).rows()).first()["regular"]


def test_long_gaps_open_in_levels(make, monkeypatch):
    monkeypatch.setattr(reshape, "STRETCH", 4)
    df = make([("a", 1, 0, 0.0, 0.0), ("a", 2, 23, 1.0, 0.0)])
    assert [r[0] for r in reshape.set_na(df, 0, S).orderBy("us").select("us").collect()] == [k * S for k in range(24)]


def test_interpolation_in_time_skips_missing_fixes(make):
    df = make([("a", 1, 0, 0.0, 0.0), ("a", 2, 5, None, None), ("a", 3, 20, 40.0, 10.0), ("a", 4, 27, 40.0, 24.0)])
    out = reshape.redistribute_time(df, 6 * S)
    assert rows(out.orderBy("rid"), "rid", "us", "x") == [(1, 0, 0.0), (2, 6 * S, 12.0), (3, 12 * S, 24.0), (4, 18 * S, 36.0), (5, 24 * S, 40.0)]


def walk_directly(points, length):
    """Constant steps along a path by stepping finely: the first place at the given distance."""
    out = [points[0]]
    path = []
    for (x1, y1, t1), (x2, y2, t2) in zip(points, points[1:], strict=False):
        n = 4000
        path += [(x1 + (x2 - x1) * k / n, y1 + (y2 - y1) * k / n, t1 + (t2 - t1) * k / n) for k in range(n)]
    path.append(points[-1])
    for p in path:
        if math.hypot(p[0] - out[-1][0], p[1] - out[-1][1]) >= length:
            out.append(p)
    return out


@pytest.mark.parametrize("limit", ["1000", "4"])
def test_constant_steps_against_a_fine_walk(make, spark, small_groups, limit):
    spark.conf.set("spark.trajspark.hotRows", limit)
    rng = random.Random(3)
    fixes = {b: [(rng.uniform(0, 9), rng.uniform(0, 9), 10.0 * k) for k in range(12)] for b in ("a", "b")}
    fixes["a"][4] = fixes["a"][3][:2] + (40.0,)  # a stop
    data = [(b, 100 * j + k, int(t), x, y) for j, b in enumerate(fixes) for k, (x, y, t) in enumerate(fixes[b])]
    out = reshape.redistribute_space(make(data), 2.5)
    for b, points in fixes.items():
        got = [(r["x"], r["y"], r["us"] / S) for r in out.filter(F.col("burst_name") == b).orderBy("rid").collect()]
        want = walk_directly(points, 2.5)
        assert len(got) == len(want)
        for g, w in zip(got, want, strict=True):
            assert g == pytest.approx(w, abs=0.08)
        for p, q in zip(got, got[1:], strict=False):
            assert math.hypot(p[0] - q[0], p[1] - q[1]) == pytest.approx(2.5, abs=1e-9)


def test_cut_ends_a_piece_at_the_step_that_meets(make):
    df = make([("a", k, k, x, 0.0) for k, x in enumerate([0.0, 1.0, 9.0, 10.0, 30.0])])
    out = reshape.cut(reshape.recompute(df), "dist > 5").rows()
    assert rows(out, "rid", "burst_name") == [(0, "a.1"), (1, "a.1"), (2, "a.2"), (3, "a.2"), (4, "a.3")]
    back = reshape.bind(out.select(*df.columns))
    assert {r[0] for r in rows(back, "burst_name")} == {"a"}


def test_combine_wants_unique_bursts(make):
    df = make([("a", 1, 1, 0.0, 0.0)])
    with pytest.raises(ValueError, match="more than one trajectory"):
        reshape.combine(df, df)
    both = reshape.combine(df, reshape.rename_bursts(df, "2").withColumn("animal_name", F.lit("a")))
    assert rows(both, "burst_name") == [("a",), ("a-2",)]


def test_subset_keeps_parameters(make):
    params = reshape.recompute(make([("a", k, k, float(k * k), 0.0) for k in range(5)])).rows()
    kept = reshape.subset(params, "dist < 4")
    assert rows(kept, "rid", "dist", "r2n") == [(0, 1.0, 0.0), (1, 3.0, 1.0)]


def test_lines_come_in_bounded_parts(make, spark, small_groups):
    data = [("a", k, k, float(k), 0.0) for k in range(8)] + [("b", 20, 1, None, None)]
    out = lines.burst_lines(make(data)).orderBy("burst_name", "part").collect()
    assert [(r["burst_name"], r["part"], r["n_points"]) for r in out] == [("a", 0, 3), ("a", 1, 3), ("a", 2, 2), ("b", 0, None)]
    assert [p["x"] for r in out[:3] for p in r["line"]] == [float(k) for k in range(8)]
    assert out[3]["line"] is None
    view = {r["burst_name"]: r for r in lines.burst_view(make(data), lines.burst_lines(make(data))).collect()}
    assert len(view) == 2 and (view["a"]["n_parts"], view["a"]["n_points"]) == (3, 8)
    assert (view["b"]["num_na"], view["b"]["n_parts"], view["b"]["n_points"]) == (1, 0, 0)
    assert "line" not in view["a"].asDict(), "no column holds a part of the line as if it were the line"
    parts = lines.burst_lines(make(data))
    whole = lines.whole_lines(lines.burst_view(make(data), parts), parts).orderBy("burst_name", "part").collect()
    assert [(r["burst_name"], r["n_points"], r["part"], len(r["line"] or [])) for r in whole] == [("a", 8, 0, 3), ("a", 8, 1, 3), ("a", 8, 2, 2), ("b", 0, 0, 0)]
    facts = {r["burst_name"]: (r["n_points"], r["length"]) for r in lines.line_facts(lines.burst_lines(make(data)), ["burst_name"]).collect()}
    assert facts == {"a": (8, 7.0), "b": (0, None)}


def test_step_lines_join_and_jump(spark):
    view = spark.createDataFrame(
        [("w", 1, [(0.0, 0.0), (1.0, 0.0)]), ("w", 2, [(1.0, 0.0), (1.0, 0.0)]), ("w", 3, [(1.0, 0.0), (2.0, 0.0)]), ("w", 5, [(5.0, 0.0), (6.0, 0.0)])],
        "animal_name string, step_id long, step_geom array<struct<x:double,y:double>>",
    )
    row = lines.step_lines(view, ["animal_name"]).first()
    assert [p["x"] for p in row["line"]] == [0.0, 1.0, 1.0, 2.0, 5.0, 6.0] and row["length"] == 6.0


def test_lines_are_the_same_in_any_layout(make, spark):
    def run():
        return rows(lines.point_lines(ordered(make([("a", k, k % 7, float(k), float(k % 3)) for k in range(40)])), ["burst_name"], 100), "line")

    whole = run()
    spark.conf.set("spark.trajspark.hotRows", "6")
    try:
        assert run() == whole
    finally:
        spark.conf.unset("spark.trajspark.hotRows")


def test_median_is_exact(make):
    steps = build_steps(make([("a", k, at, 0.0, 0.0) for k, at in enumerate([0, 1, 3, 6, 10])])).rows()
    assert summary.median_duration(steps).first()["increment"] == 2.5
    row = summary.default_window(summary.time_defaults(steps)).first()
    assert row["interval"] == 10.0, "the whole span, as ten medians are longer"


def test_paging(make):
    steps = build_steps(make([("a", k, k, 0.0, 0.0) for k in range(10)])).rows().withColumn("dist", F.lit(1.0))
    pages = windows.sliding_windows(steps, datetime(1970, 1, 1), timedelta(seconds=4), timedelta(seconds=2))
    assert rows(pages.filter("rid = 5"), "page") == [(1,), (2,)]
    assert rows(pages.filter("rid = 0"), "page") == [(0,)]
    with pytest.raises(ValueError):
        windows.page(steps, datetime(1970, 1, 1), timedelta(0), timedelta(seconds=1), 0)
    with pytest.raises(ValueError):
        windows.sliding_windows(steps, datetime(1970, 1, 1), timedelta(0), timedelta(seconds=1))


def test_pages_by_running_sums_are_those_of_every_step(make, spark):
    import random

    rng = random.Random(2)
    data = [(f"b{k % 5}", k, rng.randrange(0, 200), float(rng.randrange(9)), 0.0) for k in range(120)]
    steps = build_steps(make(data)).rows().withColumn("dist", F.when(F.col("rid") % 7 != 0, F.col("rid") / 3.0))
    for width, slide in ((30, 7), (7, 30), (10, 10), (95, 1)):
        wide, stride = timedelta(seconds=width), timedelta(seconds=slide)
        got = windows.pages_summary(steps, datetime(1970, 1, 1, 0, 0, 20), wide, stride).collect()
        slow = windows.sliding_windows(steps, datetime(1970, 1, 1, 0, 0, 20), wide, stride).groupBy("page", "page_start", "page_end").agg(
            F.count(F.lit(1)).alias("num_steps"), F.count_distinct("burst_name").alias("num_bursts"), F.sum("dist").alias("dist")).collect()
        plain = sorted((r["page"], r["page_start"], r["page_end"], r["num_steps"], r["num_bursts"], r["dist"] and round(r["dist"], 6)) for r in slow)
        assert sorted((r["page"], r["page_start"], r["page_end"], r["num_steps"], r["num_bursts"], r["dist"] and round(r["dist"], 6)) for r in got) == plain


def test_windows_over_relocations_are_those_over_steps(make, spark):
    import random

    from trajspark.operators.ids import with_step_ids
    from trajspark.operators.parameters import step_parameters

    rng = random.Random(9)
    data, rid = [], 0
    for b in range(60):
        x = 0.0
        for _ in range(rng.randrange(1, 14)):
            rid += 1
            x += rng.choice([0.0, 0.0, 0.0, 1.5, -2.0])
            known = rng.random() < 0.9
            at = None if rng.random() < 0.05 else rng.randrange(0, 30)
            data.append((f"b{b:02d}", rid, at, x if known else None, float(rng.randrange(2)) * (b % 3 == 0) if known else None))
    fixes = make(data)
    whole = with_step_ids(step_parameters(build_steps(fixes, numbered=True))).rows()
    columns = ["burst_name", "animal_name", "rid", "step_id", "seq", "rid2", "dist", "dt", "abs_angle", "rel_angle", "r2n"]
    for low, high in ((10, 20), (0, 40), (15, 16), (29, 30)):
        start, width = datetime(1970, 1, 1) + timedelta(seconds=low), timedelta(seconds=high - low)
        want = rows(whole.filter(f"us >= {low * 10**6} AND us < {high * 10**6}"), *columns)
        assert rows(windows.relocations_window(fixes, start, width), *columns) == want


def test_typed_infolocs(spark):
    df = spark.createDataFrame(
        [(1, "lo", "3", datetime(2024, 7, 1, 12), "2024-01-01 10:00:00"), (2, "??", "x", None, "not a time")],
        "step_id long, grade string, n string, seen timestamp_ntz, written string",
    )
    types = {
        "grade": InfoType("ordered", levels=("lo", "hi")), "n": InfoType("integer"),
        "seen": InfoType("POSIXct", zone="Europe/Paris"), "written": InfoType("POSIXlt"),
    }
    out = infolocs.typed(df, types).orderBy("step_id").collect()
    assert tuple(out[0]) == (1, "lo", 3, datetime(2024, 7, 1, 14), datetime(2024, 1, 1, 10), 1)
    assert tuple(out[1]) == (2, None, None, None, None, None)


def test_sets_of_names(make):
    bursts = summary.burst_summary(make([("a", 1, 1, 0.0, 0.0), ("b", 2, 1, 0.0, 0.0)]))
    assert rows(summary.bursts_by_name(bursts, ["a", "z"]), "burst_name") == [("a",)]
    assert summary.bursts_by_name(bursts, []).isEmpty() and summary.bursts_by_name(bursts, None).isEmpty()
    assert summary.bursts_by_name(bursts, "a", pgtraj="other").isEmpty()
