"""Steps and parameters on hand-made and random bursts, against a direct computation."""

import math
import random

import pytest
from pyspark.sql import functions as F

from trajspark.operators.parameters import step_parameters
from trajspark.operators.steps import TYPE_I, build_steps, step_geometry
from trajspark.plans.segments import LastKnown, Previous, RowNumber, RunningSum, lay_out, with_prefix


def direct(rows, fill):
    """Steps and turns one by one, as the definitions say. rows: (burst, rid, seconds, x, y)."""
    bursts = {}
    for row in rows:
        bursts.setdefault(row[0], []).append(row)
    out, last_moving = {}, None
    for burst in sorted(bursts):
        fixes = sorted(bursts[burst], key=lambda r: (r[2] is None, r[2] or 0, r[1]))
        steps = []
        for _, rid, at, x, y in fixes:
            later = [f for f in fixes if at is not None and f[2] is not None and f[2] > at]
            after = min(later, key=lambda f: (f[2], f[1])) if later else None
            known = after is not None and None not in (x, y, after[3], after[4])
            dx, dy = (after[3] - x, after[4] - y) if known else (None, None)
            dist = math.hypot(dx, dy) if known else None
            angle = math.atan2(dy, dx) if known and dist >= 1e-7 else None
            steps.append((rid, after[1] if after else None, dist, angle))
        if fill == "burst":
            last_moving = None
        for k, (rid, rid2, dist, angle) in enumerate(steps):
            turn = None
            if k and angle is not None:
                before = steps[k - 1]
                base = last_moving if before[2] is not None and before[2] < 1e-7 else before[3]
                if base is not None:
                    turn = angle - base
                    turn += 2 * math.pi if turn <= -math.pi else -2 * math.pi if turn > math.pi else 0
            out[rid] = (rid2, dist, turn)
            if angle is not None:
                last_moving = angle
    return out


def close(a, b):
    return a is None and b is None or a is not None and b is not None and abs(a - b) < 1e-9


def check(make, rows, fill="burst"):
    df = step_parameters(build_steps(make(rows)), fill).rows()
    found = {r["rid"]: (r["rid2"], r["dist"], r["rel_angle"]) for r in df.collect()}
    want = direct(rows, fill)
    assert found.keys() == want.keys()
    for rid, (rid2, dist, turn) in want.items():
        got = found[rid]
        assert got[0] == rid2 and close(got[1], dist) and close(got[2], turn), (rid, got, want[rid])


EDGES = [
    # ties share the next distinct time; a fix without a time has no successor
    ("a", 1, 10, 0.0, 0.0), ("a", 2, 10, 1.0, 0.0), ("a", 3, 20, 2.0, 2.0), ("a", 4, 20, 5.0, 5.0), ("a", 5, None, 9.0, 9.0),
    ("a", 6, None, 8.0, 8.0),
    # one fix
    ("b", 7, 10, 1.0, 1.0),
    # stationary start after a burst that moved
    ("c", 8, 1, 0.0, 0.0), ("c", 9, 2, 0.0, 0.0), ("c", 10, 3, 0.0, 0.0), ("c", 11, 4, 0.0, 1.0), ("c", 12, 5, -1.0, 1.0),
    # missing fixes, first one missing
    ("d", 13, 1, None, None), ("d", 14, 2, 0.0, 0.0), ("d", 15, 3, None, None), ("d", 16, 4, 1.0, 0.0), ("d", 17, 5, 0.0, 0.0),
]


@pytest.mark.parametrize("fill", ["burst", "pgtraj"])
def test_edges(make, fill):
    check(make, EDGES, fill)


@pytest.mark.parametrize("fill", ["burst", "pgtraj"])
def test_edges_split(make, small_groups, spark, fill):
    spark.conf.set("spark.trajspark.hotRows", "2")
    check(make, EDGES, fill)


@pytest.mark.parametrize("seed", range(3))
def test_random_bursts_split_at_any_place(make, small_groups, spark, seed):
    """One burst holds most rows, times are tied in long runs (longer than a segment), many steps do not move."""
    rng = random.Random(seed)
    spark.conf.set("spark.trajspark.hotRows", str(rng.choice([3, 6, 11])))
    rows = []
    for rid in range(1, 181):
        burst = "hot" if rng.random() < 0.7 else rng.choice("abc")
        at = None if rng.random() < 0.08 else rng.choice([rng.randrange(8), rng.randrange(60)])
        x, y = (None, None) if rng.random() < 0.1 else (float(rng.randrange(2)), float(rng.randrange(2)))
        rows.append((burst, rid, at, x, y))
    check(make, rows, rng.choice(["burst", "pgtraj"]))


def test_one_time_for_all_rows_of_a_large_burst(make, small_groups):
    rows = [("a", rid, 5, float(rid), 0.0) for rid in range(1, 60)] + [("a", 60, 9, 0.0, 0.0)]
    check(make, rows)


def test_net_displacement_is_null_when_the_first_fix_is_missing(make):
    df = step_parameters(build_steps(make(EDGES))).rows()
    r2n = {r["rid"]: r["r2n"] for r in df.collect()}
    assert all(r2n[k] is None for k in range(13, 18))
    assert r2n[8] == 0.0 and r2n[12] == 2.0


def test_type_one_follows_rid(make):
    rows = [("a", rid, None, float(rid), 0.0) for rid in (5, 3, 9)]
    found = {r["rid"]: (r["rid2"], r["dt_us"]) for r in build_steps(make(rows), TYPE_I).rows().collect()}
    assert found == {3: (5, None), 5: (9, None), 9: (None, None)}


def test_geometry_needs_a_second_relocation(make):
    rows = [("a", 1, 1, 0.0, 0.0), ("a", 2, 2, None, None), ("a", 3, 3, 1.0, 1.0)]
    found = {r["rid"]: r["step_geom"] for r in step_geometry(build_steps(make(rows)).rows()).collect()}
    assert found == {1: None, 2: None}


def test_unknown_fill_is_an_error(make):
    with pytest.raises(ValueError):
        step_parameters(build_steps(make(EDGES)), "everything")


def test_running_values_do_not_depend_on_the_layout(spark, small_groups):
    rng = random.Random(7)
    data = [(rng.choice("xy") if k % 3 else "x", k, rng.choice([None, k])) for k in range(120)]
    df = spark.createDataFrame(data, "g string, k long, v long").repartition(5)

    def run(limit):
        spark.conf.set("spark.trajspark.hotRows", str(limit))
        laid = lay_out(df, ("g",), ("k",))
        laid = with_prefix(laid, n=RowNumber(), s=RunningSum(F.col("v")), p=Previous(F.col("v")), known=LastKnown(F.col("v")))
        return laid.split, sorted(map(tuple, laid.rows().select("g", "k", "n", "s", "p", "known").collect()))

    whole, split = run(1000), run(7)
    assert not whole[0] and split[0]

    assert whole[1] == split[1]


def test_plain_layout_makes_one_shuffle(make):
    df = step_parameters(build_steps(make(EDGES))).rows()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan
