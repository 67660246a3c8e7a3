"""SQL counterparts of the registered queries, for a single-node engine over the same tables.

They state the semantics independently: as-of joins for the next and the last moving step, plain window functions
elsewhere.
"""

from __future__ import annotations

import re

from trajspark.suite.fixtures import HOUR_US, START_US

ORACLES: dict[str, str] = {}

PROJ = "+proj=merc +lon_0=0 +k=1 +x_0=0 +y_0=0 +datum=WGS84 +units=m +no_defs"
BURST = "pgtraj_name, burst_name"


def r(expr: str, name: str, places: int = 6) -> str:
    """Rounded, without negative zeros."""
    tiny = f"{0.5 * 10.0**-places:.12f}"
    return f'CASE WHEN abs({expr}) < {tiny}e0 THEN 0e0 ELSE round({expr}, {places}) END AS "{name}"'


def reloc(ts: str = "ts", burst: str = "concat('a', user_id, '-', event_type)", where: str = "true") -> str:
    """Bound relocations from events."""
    missing = "event_type = 'error' AND event_id % 7 = 0"
    return f"""reloc AS (
  SELECT event_id AS rid, {ts} AS fix_at, epoch_us({ts}) AS us,
         CASE WHEN {missing} THEN NULL ELSE floor(value / 40e0) * 10.5e0 END AS x,
         CASE WHEN {missing} THEN NULL ELSE (event_id % 3) * 7.25e0 END AS y,
         concat('p', user_id % 4) AS pgtraj_name, concat('a', user_id) AS animal_name, {burst} AS burst_name,
         user_id, event_type, props, value
  FROM events WHERE {where})"""


SUPPLIERS = """reloc AS (
  SELECT (l_suppkey * 1000000 + l_partkey) * 100000 + date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS rid,
         l_shipdate AS fix_at, epoch_us(l_shipdate) AS us, min(l_quantity) AS x, max(l_quantity) AS y, 'suppliers' AS pgtraj_name,
         concat('s', l_suppkey) AS animal_name, concat('s', l_suppkey) AS burst_name
  FROM lineitem GROUP BY l_suppkey, l_partkey, l_shipdate)"""


def steps(source: str | None = None, at: str = "us", base: str = "reloc") -> str:
    """Each relocation with the first one of its burst that is strictly later."""
    source = reloc() if source is None else source
    return f"""{source},
moments AS (SELECT {BURST}, {at} AS at2, min(rid) AS first_rid FROM {base} WHERE {at} IS NOT NULL GROUP BY ALL),
linked AS (
  SELECT a.*, m.first_rid FROM {base} a ASOF LEFT JOIN moments m
  ON a.pgtraj_name = m.pgtraj_name AND a.burst_name = m.burst_name AND a.{at} < m.at2),
step AS (
  SELECT a.*, b.rid AS rid2, b.us AS us2, b.x AS x2, b.y AS y2, b.us - a.us AS dt_us
  FROM linked a LEFT JOIN {base} b ON a.first_rid = b.rid AND a.pgtraj_name = b.pgtraj_name AND a.burst_name = b.burst_name)"""


def params(source: str | None = None, fill: str = "burst", at: str = "us", base: str = "reloc") -> str:
    """All parameters; the last moving step before a stationary one is found by an as-of join on the step number."""
    same = "p.pgtraj_name = m.pgtraj_name" + (" AND p.burst_name = m.burst_name" if fill == "burst" else "")
    order = "us NULLS LAST, rid" if at == "us" else "rid"
    return f"""{steps(source, at, base)},
shaped AS (
  SELECT *, x2 - x AS dx, y2 - y AS dy, sqrt((x2 - x) * (x2 - x) + (y2 - y) * (y2 - y)) AS dist,
         row_number() OVER (ORDER BY {BURST}, {order}) AS gid,
         row_number() OVER (PARTITION BY {BURST} ORDER BY {order}) AS seq
  FROM step),
directed AS (SELECT *, CASE WHEN dist >= 1e-7 THEN atan2(dy, dx) END AS abs_angle FROM shaped),
moving AS (SELECT {BURST}, gid, abs_angle FROM directed WHERE dist >= 1e-7),
origin AS (SELECT {BURST}, x AS x0, y AS y0 FROM directed WHERE seq = 1),
before AS (
  SELECT p.*, m.abs_angle AS known FROM directed p ASOF LEFT JOIN moving m ON {same} AND p.gid >= m.gid),
turned AS (
  SELECT d.*, d.abs_angle - CASE WHEN b.dist < 1e-7 THEN b.known ELSE b.abs_angle END AS turn
  FROM directed d LEFT JOIN before b
  ON d.pgtraj_name = b.pgtraj_name AND d.burst_name = b.burst_name AND d.seq = b.seq + 1),
par AS (
  SELECT t.*, t.dt_us / 1e6 AS dt, (t.x - o.x0) * (t.x - o.x0) + (t.y - o.y0) * (t.y - o.y0) AS r2n,
         CASE WHEN turn <= -pi() THEN turn + 2 * pi() WHEN turn > pi() THEN turn - 2 * pi() ELSE turn END AS rel_angle
  FROM turned t JOIN origin o USING ({BURST}))"""


NUMBERS = ", ".join(r(c, c) for c in ("dx", "dy", "dist", "dt", "r2n", "abs_angle", "rel_angle"))


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def written(sql: str) -> str:
    """Every common table computed once, so that no join order can repeat the work of another."""
    return re.sub(r"(?m)^((?:WITH )?\w+) AS \(", r"\1 AS MATERIALIZED (", sql)


# inverse Mercator: isometric latitude by direct iteration on the latitude
ECC = "0.081819190842621494e0"


def longlat(x: str, y: str) -> tuple[str, str]:
    lat = f"(pi() / 2 - 2 * atan(exp(-({y}) / 6378137e0)))"
    for _ in range(7):
        lat = f"(pi() / 2 - 2 * atan(exp(-({y}) / 6378137e0 - {ECC} * atanh({ECC} * sin{lat}))))"
    return f"degrees(({x}) / 6378137e0)", f"degrees({lat})"


VIEW = (
    params()
    + f""",
line AS (
  SELECT *, gid AS step_id, {longlat("x", "y")[0]} AS ax, {longlat("x", "y")[1]} AS ay,
         {longlat("x2", "y2")[0]} AS bx, {longlat("x2", "y2")[1]} AS by_
  FROM par WHERE x IS NOT NULL AND x2 IS NOT NULL)"""
)


def joined_lines(keys: str, where: str = "true") -> str:
    """Vertex lists of step lines: a step adds its start unless the step before ended there."""
    return f"""{VIEW},
chosen AS (SELECT * FROM line WHERE {where}),
prior AS (
  SELECT *, lag(x2) OVER w AS px, lag(y2) OVER w AS py, lag(bx) OVER w AS pbx, lag(by_) OVER w AS pby
  FROM chosen WINDOW w AS (PARTITION BY {keys} ORDER BY step_id)),
vertex AS (
  SELECT {keys}, step_id, 1 AS k, ax AS vx, ay AS vy FROM prior WHERE px IS NULL OR px <> x OR py <> y
  UNION ALL SELECT {keys}, step_id, 2, bx, by_ FROM prior),
way AS (
  SELECT *, sqrt((vx - lag(vx) OVER w) ** 2 + (vy - lag(vy) OVER w) ** 2) AS d
  FROM vertex WINDOW w AS (PARTITION BY {keys} ORDER BY step_id, k))
SELECT {keys}, count(*) AS n_points, {r("first(vx ORDER BY step_id, k)", "first_x", 9)}, {r("first(vy ORDER BY step_id, k)", "first_y", 9)},
       {r("last(vx ORDER BY step_id, k)", "last_x", 9)}, {r("last(vy ORDER BY step_id, k)", "last_y", 9)},
       {r("coalesce(sum(d), 0e0)", "length", 9)}
FROM way GROUP BY {keys}"""


# -- binding
BOUND_COLUMNS = (
    f"rid, us, x, y, CAST(3395 AS INTEGER) AS srid, pgtraj_name, animal_name, burst_name, '{PROJ}' AS proj4string, "
    "'Europe/Paris' AS time_zone"
)
ORACLES["relocations_bound"] = with_(reloc(), f"SELECT {BOUND_COLUMNS}, CAST(NULL AS VARCHAR) AS note FROM reloc")
ORACLES["relocations_point_column"] = with_(reloc(), f"SELECT {BOUND_COLUMNS}, 'from points' AS note FROM reloc")
ORACLES["clauses_filter"] = with_(
    steps(reloc(where="event_type IN ('click', 'error') AND extract(day FROM ts) <= 10")), "SELECT rid, rid2, dt_us FROM step"
)
ORACLES["burst_default"] = """
SELECT concat('p', user_id % 4) AS pgtraj_name, concat('a', user_id) AS animal_name, concat('a', user_id) AS burst_name, count(*) AS n
FROM events GROUP BY ALL"""
ORACLES["name_conflicts"] = """
SELECT 'burst of several animals' AS problem, concat('p', user_id % 4) AS pgtraj_name, event_type AS burst_name,
       count(DISTINCT user_id) AS n
FROM events GROUP BY 2, 3 HAVING count(DISTINCT user_id) > 1"""

# -- steps
DAY, SOME = "date_trunc('day', ts)", "CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END"
PAIR = "SELECT rid, rid2, dt_us, x2, y2 FROM step"
ORACLES["steps_type2"] = with_(steps(), PAIR)
ORACLES["steps_type2_ties"] = with_(steps(reloc(DAY)), PAIR)
ORACLES["steps_null_time"] = with_(steps(reloc(SOME)), PAIR)
ORACLES["steps_type1"] = with_(
    reloc(),
    f"""SELECT rid, lead(rid) OVER w AS rid2, CAST(NULL AS BIGINT) AS dt_us, lead(x) OVER w AS x2, lead(y) OVER w AS y2
FROM reloc WINDOW w AS (PARTITION BY {BURST} ORDER BY rid)""",
)
ORACLES["relocations_type1_points"] = with_(
    reloc(),
    f"""SELECT rid, lead(rid) OVER w AS rid2, CAST(NULL AS BIGINT) AS us, CAST(3395 AS INTEGER) AS srid, lead(x) OVER w AS x2, lead(y) OVER w AS y2
FROM reloc WINDOW w AS (PARTITION BY {BURST} ORDER BY rid)""",
)
ORACLES["steps_heavy_ties"] = with_(steps(SUPPLIERS), "SELECT animal_name, rid, rid2, dt_us FROM step")
COMPUTED = (
    params()
    + """,
own AS (
  SELECT *, CAST(rid AS VARCHAR) AS r_rowname, CAST(floor(us / 1000000) AS BIGINT) * 1000000 AS us1,
         CAST(round(dt) AS BIGINT) * 1000000 AS whole FROM par)"""
)
ORACLES["steps_from_computed"] = with_(
    COMPUTED,
    f"""SELECT r_rowname, us1 AS us, us1 + whole AS us2, whole AS dt_us, x, y, {r("x + dx", "x2")}, {r("y + dy", "y2")} FROM own""",
)
ORACLES["step_ids"] = with_(
    steps()
    + f""",
numbered AS (
  SELECT *, row_number() OVER (ORDER BY {BURST}, us NULLS LAST, rid) AS step_id, dense_rank() OVER (ORDER BY {BURST}) AS burst_id
  FROM step)""",
    """SELECT a.step_id, a.burst_id, a.step_id AS relocation_id_1, b.step_id AS relocation_id_2, a.rid
FROM numbered a LEFT JOIN numbered b ON a.rid2 = b.rid""",
)
ORACLES["step_burst_relation"] = with_(
    reloc()
    + f""",
numbered AS (
  SELECT *, row_number() OVER (ORDER BY {BURST}, us NULLS LAST, rid) AS step_id, dense_rank() OVER (ORDER BY {BURST}) AS burst_id,
         dense_rank() OVER (ORDER BY pgtraj_name) AS pgtraj_id
  FROM reloc)""",
    f"""SELECT pgtraj_id, burst_id AS animal_burst_id, count(*) AS n, min(step_id) AS first_step, burst_name, animal_name, pgtraj_name,
       '{PROJ}' AS proj4string FROM numbered GROUP BY ALL""",
)

# -- parameters
FULL = f"x, y, {NUMBERS}"
ORACLES["step_parameters_computed"] = with_(params(), f"SELECT pgtraj_name, animal_name, burst_name, seq, rid, {FULL} FROM par")
ORACLES["step_parameters_pgtraj_fill"] = with_(params(fill="pgtraj"), f"SELECT pgtraj_name, burst_name, seq, rid, {FULL} FROM par")
ORACLES["step_parameters_ties"] = with_(params(reloc(DAY), "pgtraj"), f"SELECT pgtraj_name, burst_name, seq, rid, {FULL} FROM par")
ORACLES["step_parameters_heavy_ties"] = written(with_(params(SUPPLIERS), f"SELECT burst_name, seq, rid, {FULL} FROM par"))
ORACLES["stored_parameters_imported"] = with_(
    COMPUTED
    + """,
again AS (
  SELECT * REPLACE (x + dx - x AS dx, y + dy - y AS dy, CAST(whole AS DOUBLE) / 1e6 AS dt) FROM own),
lengths AS (SELECT * REPLACE (sqrt(dx * dx + dy * dy) AS dist) FROM again),
angles AS (SELECT * REPLACE (CASE WHEN dist >= 1e-7 THEN atan2(dy, dx) END AS abs_angle) FROM lengths)""",
    f"SELECT pgtraj_name, burst_name, r_rowname, {FULL} FROM angles",
)
ORACLES["step_geometry_lines"] = with_(
    steps(),
    """SELECT rid, CASE WHEN x2 IS NOT NULL THEN x END AS x1, CASE WHEN x2 IS NOT NULL THEN y END AS y1,
       CASE WHEN x IS NOT NULL THEN x2 END AS x2, CASE WHEN x IS NOT NULL THEN y2 END AS y2
FROM step WHERE rid2 IS NOT NULL""",
)

# -- summaries
ORACLES["pgtraj_summary"] = with_(
    reloc(),
    """SELECT pgtraj_name, count(DISTINCT burst_name) AS num_bursts, count(*) AS num_relocations, min(fix_at) AS earliest_date,
       max(fix_at) AS latest_date FROM reloc GROUP BY 1""",
)
ORACLES["pgtraj_summary_shared_names"] = with_(
    reloc(burst="event_type"),
    """SELECT pgtraj_name, count(DISTINCT burst_name) AS num_bursts, count(*) AS num_relocations, min(fix_at) AS earliest_date,
       max(fix_at) AS latest_date FROM reloc GROUP BY 1""",
)
ORACLES["burst_summary"] = with_(
    reloc(),
    """SELECT pgtraj_name, animal_name, burst_name, count(*) AS num_relocations, count(*) - count(x) AS num_na, min(fix_at) AS date_begin,
       max(fix_at) AS date_end FROM reloc GROUP BY 1, 2, 3""",
)
BURST_LINES = with_(
    reloc()
    + f""",
way AS (
  SELECT *, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS d FROM reloc WHERE x IS NOT NULL
  WINDOW w AS (PARTITION BY {BURST} ORDER BY us, rid)),
lines AS (
  SELECT {BURST}, count(*) AS n, first(x ORDER BY us, rid) AS fx, first(y ORDER BY us, rid) AS fy, last(x ORDER BY us, rid) AS lx,
         last(y ORDER BY us, rid) AS ly, coalesce(sum(d), 0e0) AS len
  FROM way GROUP BY ALL),
names AS (SELECT DISTINCT {BURST} FROM reloc)""",
    f"""SELECT {BURST}, coalesce(n, 0) AS n_points, {r("fx", "first_x", 9)}, {r("fy", "first_y", 9)}, {r("lx", "last_x", 9)},
       {r("ly", "last_y", 9)}, {r("len", "length", 9)} FROM names LEFT JOIN lines USING ({BURST})""",
)
ORACLES["burst_lines"] = BURST_LINES
ORACLES["bursts_by_name"] = f"""
SELECT pgtraj_name, animal_name, burst_name, num_relocations, num_na, n_points, CASE WHEN n_points > 0 THEN length END AS length
FROM ({ORACLES["burst_summary"]}) JOIN ({BURST_LINES}) USING (pgtraj_name, burst_name)
WHERE burst_name IN ('a1-click', 'a2-error', 'nobody')"""
ORACLES["animal_lines"] = "WITH " + joined_lines("pgtraj_name, animal_name")
ORACLES["distinct_bursts"] = "SELECT DISTINCT concat('a', user_id, '-', event_type) AS burst_name FROM events"
ORACLES["distinct_animals"] = "SELECT DISTINCT concat('a', user_id) AS animal_name FROM events"
DEFAULTS = with_(
    steps(),
    """SELECT pgtraj_name, min(fix_at) AS tstamp_start, max(fix_at) AS tstamp_last, quantile_cont(dt_us, 0.5) / 1e6 AS increment
FROM step WHERE x IS NOT NULL AND x2 IS NOT NULL GROUP BY 1""",
)
ORACLES["time_defaults"] = DEFAULTS
ORACLES["default_window"] = f"""
SELECT *, CASE WHEN increment * 10 < (epoch_us(tstamp_last) - epoch_us(tstamp_start)) / 1e6 THEN increment * 10
          ELSE (epoch_us(tstamp_last) - epoch_us(tstamp_start)) / 1e6 END AS interval FROM ({DEFAULTS})"""
ORACLES["selection_changes"] = with_(
    reloc()
    + """,
wanted AS (SELECT DISTINCT burst_name FROM reloc WHERE x > 0 AND extract(month FROM fix_at) = 1),
shown AS (SELECT DISTINCT burst_name FROM reloc WHERE y > 0)""",
    """SELECT burst_name, 'add' AS change FROM (FROM wanted EXCEPT FROM shown)
UNION ALL SELECT burst_name, 'remove' FROM (FROM shown EXCEPT FROM wanted)""",
)

# -- windows
INSIDE = "fix_at >= TIMESTAMP '2024-01-10' AND fix_at < TIMESTAMP '2024-01-10' + INTERVAL 172800 SECOND"
ORACLES["window_steps"] = with_(
    VIEW,
    f"""SELECT step_id, fix_at AS date, {r("ax", "x1", 9)}, {r("ay", "y1", 9)}, {r("bx", "x2", 9)}, {r("by_", "y2", 9)},
       {", ".join(r(c, c) for c in ("dx", "dy", "dist", "dt", "abs_angle", "rel_angle"))}, animal_name, burst_name, pgtraj_name
FROM line WHERE {INSIDE}""",
)
ORACLES["window_lines"] = "WITH " + joined_lines("pgtraj_name, burst_name, animal_name", INSIDE)
ORACLES["sliding_windows"] = with_(
    VIEW
    + """,
pages AS (
  SELECT CAST(k AS BIGINT) AS page, TIMESTAMP '2024-01-01' + to_days(CAST(k AS INTEGER)) AS page_start,
         TIMESTAMP '2024-01-01' + to_days(CAST(k AS INTEGER) + 3) AS page_end
  FROM range(0, 60) t(k))""",
    """SELECT pgtraj_name, page, page_start, page_end, count(*) AS num_steps, count(DISTINCT burst_name) AS num_bursts,
       round(sum(dist), 6) AS dist
FROM line JOIN pages ON fix_at >= page_start AND fix_at < page_end GROUP BY 1, 2, 3, 4""",
)

# -- infolocs
NUMBERED = (
    steps()
    + f""",
numbered AS (
  SELECT *, row_number() OVER (ORDER BY {BURST}, us NULLS LAST, rid) AS step_id FROM step),
info AS (
  SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k, event_type AS status, value * 2 AS step_id_1, ts
  FROM events WHERE event_id % 11 <> 0)"""
)
ON_RID = "FROM numbered JOIN info ON rid = event_id"
ORACLES["infolocs_attach"] = with_(NUMBERED, f"SELECT step_id, k, status, step_id_1 {ON_RID}")
ORACLES["infolocs_from_trajectory"] = with_(NUMBERED, f"SELECT step_id, k, step_id_1 {ON_RID}")
ORACLES["infolocs_union"] = with_(
    NUMBERED, "SELECT event_id, CASE WHEN status = 'click' THEN k END AS k, CASE WHEN status <> 'click' THEN status END AS status FROM info"
)
RANK = "CASE status WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 END"
ORACLES["infolocs_typed"] = with_(
    NUMBERED,
    f"""SELECT step_id, CAST(k AS DOUBLE) AS k, CASE WHEN {RANK} > 0 THEN status END AS status, CAST({RANK} AS BIGINT) AS status_level,
       ts + INTERVAL 1 HOUR AS seen, ts AS written {ON_RID}""",
)
ORACLES["infolocs_typed_by_burst"] = with_(
    NUMBERED,
    f"SELECT step_id, k, CASE WHEN user_id % 2 = 1 OR {RANK} > 0 THEN status END AS status {ON_RID}",
)
ORACLES["view_with_infolocs"] = with_(
    VIEW
    + """,
info AS (
  SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k, event_type AS status
  FROM events WHERE event_id % 11 <> 0)""",
    f"SELECT step_id, fix_at AS date, {r('dist', 'dist')}, k, status, burst_name, pgtraj_name FROM line JOIN info ON rid = event_id",
)

# -- life cycle
IDS = (
    steps()
    + f""",
numbered AS (SELECT *, row_number() OVER (ORDER BY {BURST}, us NULLS LAST, rid) AS step_id FROM step)"""
)
ORACLES["drop_pgtraj"] = with_(
    IDS,
    """SELECT a.step_id, a.step_id AS relocation_id_1, b.step_id AS relocation_id_2, a.burst_name, a.animal_name, a.rid AS orig_id
FROM numbered a LEFT JOIN numbered b ON a.rid2 = b.rid WHERE a.pgtraj_name <> 'p1'""",
)
ORACLES["unused_relocations"] = with_(IDS, "SELECT step_id AS id, rid AS orig_id, us FROM numbered WHERE pgtraj_name = 'p2'")
ORACLES["overwrite"] = with_(
    reloc(),
    """SELECT pgtraj_name, CASE WHEN pgtraj_name = 'p3' THEN concat(burst_name, '-new') ELSE burst_name END AS burst_name,
       count(*) AS n, max(rid) AS last_rid FROM reloc GROUP BY 1, 2""",
)

# -- export
EXPORTED = ", ".join([r("dx", "dx"), r("dy", "dy"), r("dist", "dist"), "{dt}", r("r2n", "R2n"), r("abs_angle", "abs.angle"),
                      r("rel_angle", "rel.angle")])
ORACLES["export_long"] = with_(
    params(),
    f"""SELECT pgtraj_name, seq, x, y, fix_at + INTERVAL 1 HOUR AS date, {EXPORTED.format(dt=r("dt", "dt"))}, animal_name AS id,
       burst_name AS burst FROM par""",
)
ORACLES["export_type1"] = with_(
    params(reloc(), at="rid"),
    f"""SELECT pgtraj_name, seq, x, y, row_number() OVER (PARTITION BY pgtraj_name ORDER BY burst_name, seq) AS date,
       {EXPORTED.format(dt="CASE WHEN rid2 IS NOT NULL THEN 1e0 END AS dt")}, animal_name AS id, burst_name AS burst FROM par""",
)
ORACLES["export_type1_named"] = with_(
    params(reloc(), at="rid"),
    f"""SELECT pgtraj_name, seq, x, y, rid * 2 AS date, {EXPORTED.format(dt="CASE WHEN rid2 IS NOT NULL THEN 1e0 END AS dt")},
       animal_name AS id, burst_name AS burst FROM par""",
)
ORACLES["export_nested"] = with_(
    params(),
    """SELECT pgtraj_name, animal_name AS id, burst_name AS burst, count(*) AS n_rows, round(coalesce(sum(dist), 0e0), 6) AS way,
       count(*) FILTER (x IS NULL) AS n_missing FROM par GROUP BY 1, 2, 3""",
)
ORACLES["nested_to_long"] = with_(
    params(),
    """SELECT pgtraj_name, animal_name AS id, burst_name AS burst, seq, x, y, fix_at + INTERVAL 1 HOUR AS date, round(dist, 6) AS dist
FROM par""",
)

# -- store
ORACLES["store_parameters"] = with_(
    params(fill="pgtraj"),
    f"SELECT gid AS step_id, fix_at AS date, animal_name, burst_name AS burst, pgtraj_name AS pgtraj, {FULL} FROM par",
)
STORED_INFO = """,
info AS (
  SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k, event_type AS status
  FROM events WHERE event_id % 11 <> 0)"""
ORACLES["store_import"] = with_(
    params(fill="pgtraj") + STORED_INFO,
    f"""SELECT seq, x, y, date_trunc('second', fix_at) + INTERVAL 1 HOUR AS date, {EXPORTED.format(dt=r("round(dt)", "dt"))},
       animal_name AS id, burst_name AS burst, i.k, CASE WHEN {RANK} > 0 THEN status END AS status
FROM par LEFT JOIN info i ON rid = i.event_id WHERE pgtraj_name = 'p0'""",
)
ORACLES["store_views"] = "WITH " + joined_lines(
    "pgtraj_name, burst_name, animal_name", f"pgtraj_name = 'p1' AND rid % 11 <> 0 AND {INSIDE}"
)
ORACLES["store_summaries"] = with_(
    reloc()
    + f""",
bursts AS (
  SELECT {BURST}, count(*) AS num_relocations, count(*) - count(x) AS num_na, min(fix_at) AS date_begin
  FROM reloc WHERE pgtraj_name <> 'p2' GROUP BY ALL),
groups AS (SELECT pgtraj_name, count(DISTINCT burst_name) AS num_bursts, max(fix_at) AS latest_date FROM reloc
           WHERE pgtraj_name <> 'p2' GROUP BY 1)""",
    """SELECT *, num_relocations - num_na AS n_points, concat('infolocs_', pgtraj_name) AS infolocs_table
FROM bursts JOIN (SELECT *, row_number() OVER (ORDER BY pgtraj_name) AS pgtraj_id FROM groups) USING (pgtraj_name)""",
)
ORACLES["store_burst_lines"] = with_(
    reloc()
    + f""",
placed AS (SELECT * REPLACE ({longlat("x", "y")[0]} AS x, {longlat("x", "y")[1]} AS y), x AS mx, y AS my FROM reloc WHERE x IS NOT NULL),
way AS (
  SELECT *, sqrt((mx - lag(mx) OVER w) ** 2 + (my - lag(my) OVER w) ** 2) AS d FROM placed
  WINDOW w AS (PARTITION BY {BURST} ORDER BY us, rid)),
lines AS (
  SELECT {BURST}, count(*) AS n, first(x ORDER BY us, rid) AS fx, first(y ORDER BY us, rid) AS fy, last(x ORDER BY us, rid) AS lx,
         last(y ORDER BY us, rid) AS ly, coalesce(sum(d), 0e0) AS len
  FROM way GROUP BY ALL),
names AS (SELECT DISTINCT {BURST} FROM reloc)""",
    f"""SELECT {BURST}, coalesce(n, 0) AS n_points, {r("fx", "first_x", 9)}, {r("fy", "first_y", 9)}, {r("lx", "last_x", 9)},
       {r("ly", "last_y", 9)}, {r("len", "length", 9)} FROM names LEFT JOIN lines USING ({BURST})""",
)
ORACLES["store_export_import"] = with_(
    params(fill="pgtraj"),
    f"""SELECT seq, x, y, date_trunc('second', fix_at) + INTERVAL 1 HOUR AS date, {r("dist", "dist")}, {r("r2n", "R2n")},
       animal_name AS id, burst_name AS burst, '{PROJ}' AS proj4string, 'Europe/Paris' AS time_zone FROM par WHERE pgtraj_name = 'p3'""",
)
ORACLES["store_transfer"] = with_(
    params(fill="pgtraj"),
    f"""SELECT x, y, {r("dx", "dx")}, {r("dy", "dy")}, {r("r2n", "r2n")}, {r("rel_angle", "rel_angle")}, animal_name, burst_name AS burst
FROM par WHERE pgtraj_name = 'p2'""",
)
ORACLES["store_import_type1"] = with_(
    params(reloc(), at="rid"),
    f"""SELECT seq, x, y, row_number() OVER (ORDER BY burst_name, seq) AS date, CASE WHEN rid2 IS NOT NULL THEN 1e0 END AS dt,
       {r("dist", "dist")}, animal_name AS id, burst_name AS burst, '+proj=tmerc +lat_0=49 +lon_0=-2 +ellps=airy' AS proj4string
FROM par WHERE pgtraj_name = 'p1'""",
)
ORACLES["store_page"] = with_(
    params(fill="pgtraj") + STORED_INFO,
    f"""SELECT gid AS step_id, fix_at AS date, {r("dist", "dist")}, {r("dt", "dt")}, animal_name, burst_name, i.k
FROM par JOIN info i ON rid = i.event_id
WHERE pgtraj_name = 'p2' AND x IS NOT NULL AND x2 IS NOT NULL AND fix_at >= TIMESTAMP '2024-01-04' AND fix_at < TIMESTAMP '2024-01-06'""",
)

# -- store, every pgtraj
ORACLES["store_export_import_all"] = with_(
    params(fill="pgtraj"),
    f"""SELECT pgtraj_name, seq, x, y, date_trunc('second', fix_at) + INTERVAL 1 HOUR AS date, {r("dist", "dist")}, {r("r2n", "R2n")},
       animal_name AS id, burst_name AS burst, '{PROJ}' AS proj4string, 'Europe/Paris' AS time_zone FROM par""",
)
ORACLES["store_transfer_all"] = with_(
    params(fill="pgtraj"),
    f"""SELECT pgtraj_name, x, y, {r("dx", "dx")}, {r("dy", "dy")}, {r("r2n", "r2n")}, {r("rel_angle", "rel_angle")}, animal_name, burst_name AS burst
FROM par""",
)
ORACLES["store_import_type1_all"] = with_(
    params(reloc(), at="rid"),
    f"""SELECT seq, x, y, row_number() OVER (ORDER BY burst_name, seq) AS date, CASE WHEN rid2 IS NOT NULL THEN 1e0 END AS dt,
       {r("dist", "dist")}, animal_name AS id, burst_name AS burst, '+proj=tmerc +lat_0=49 +lon_0=-2 +ellps=airy' AS proj4string
FROM par""",
)
ORACLES["store_page_all"] = with_(
    params(fill="pgtraj") + STORED_INFO,
    f"""SELECT pgtraj_name, gid AS step_id, fix_at AS date, {r("dist", "dist")}, {r("dt", "dt")}, animal_name, burst_name, i.k
FROM par JOIN info i ON rid = i.event_id
WHERE x IS NOT NULL AND x2 IS NOT NULL AND fix_at >= TIMESTAMP '2024-01-04' AND fix_at < TIMESTAMP '2024-01-06'""",
)

# -- reference systems, layers, sensors
LON, LAT = "((event_id % 3601) / 10e0 - 180e0)", "((event_id % 1601) / 10e0 - 80e0)"
ORACLES["reproject_3395"] = f"""
SELECT event_id, {r(longlat(f"{LON} * 111319e0", f"{LAT} * 190000e0")[0], "x", 9)},
       {r(longlat(f"{LON} * 111319e0", f"{LAT} * 190000e0")[1], "y", 9)} FROM events"""
ORACLES["reproject_round_trip"] = f"SELECT event_id, {r(f'({LON} / 60e0 - 81e0)', 'x', 8)}, {r(LAT, 'y', 8)} FROM events"
ORACLES["layer_types"] = with_(
    steps(),
    """SELECT 'points' AS layer, count(DISTINCT x IS NULL) AS types, count(*) AS n, bool_or(x IS NULL) AS multi FROM reloc
UNION ALL SELECT 'lines', 1, count(*), false FROM step WHERE x2 IS NOT NULL""",
)
ORACLES["layer_to_longlat"] = with_(
    reloc(),
    f"""SELECT rid AS event_id, CAST(4326 AS INTEGER) AS srid, {r(longlat("x", "y")[0], "x", 9)}, {r(longlat("x", "y")[1], "y", 9)}
FROM reloc WHERE x IS NOT NULL""",
)
MIXED = f"""SELECT rid AS event_id, CAST(4326 AS INTEGER) AS srid,
       {r(f"(CASE WHEN rid % 2 = 0 THEN {longlat('x', 'y')[0]} ELSE x END)", "x", 9)},
       {r(f"(CASE WHEN rid % 2 = 0 THEN {longlat('x', 'y')[1]} ELSE y END)", "y", 9)}
FROM reloc WHERE x IS NOT NULL"""
ORACLES["layer_mixed_systems"] = with_(reloc(), MIXED)
ORACLES["layers_by_name"] = f"SELECT 'fixes' AS layer, * FROM ({ORACLES['layer_to_longlat']})"
ORACLES["gps_fixes"] = """
SELECT concat('s', user_id % 5) AS sensor, CAST(event_id AS INTEGER) AS line_no, strftime(ts, '%d/%m/%Y') AS utc_date,
       strftime(ts, '%d/%m/%Y') AS lmt_date, value AS latitude, CAST(user_id * 10 AS INTEGER) AS easting, event_type AS remarks,
       date_trunc('second', ts) AS acquired
FROM events"""
ORACLES["gps_files"] = ORACLES["gps_fixes"]

ORACLES["gps_folder"] = ORACLES["gps_fixes"].replace("concat('s', user_id % 5)", "concat('u', user_id)")
ORACLES["gps_descriptions"] = """
SELECT DISTINCT CAST(user_id AS INTEGER) AS animals_id, concat('A', user_id) AS animals_code, concat('name ', user_id) AS animal_name,
       CASE WHEN user_id % 2 = 0 THEN 'f' ELSE 'm' END AS sex, concat('GSM', user_id) AS gps_sensors_code, 150.25e0 AS frequency,
       '2005-01-01 00:00:00' AS start_time, 'note' AS notes FROM events"""

# -- reshaping
STEP4, STEP6 = 4 * HOUR_US, 6 * HOUR_US
GRID = f"CAST(floor((us - {START_US}) / {STEP4}e0 + 0.5e0) AS BIGINT)"
ON_GRID = f"({START_US} + {GRID} * {STEP4})"
ORACLES["set_na"] = with_(
    reloc()
    + f""",
gridded AS (SELECT *, {GRID} AS g, lead({GRID}) OVER (PARTITION BY {BURST} ORDER BY us, rid) AS g2 FROM reloc),
gaps AS (SELECT {BURST}, unnest(range(g + 1, g2)) AS k FROM gridded WHERE g2 > g + 1)""",
    f"""SELECT {BURST}, rid, us, x, y FROM reloc
UNION ALL SELECT {BURST}, NULL, {START_US} + k * {STEP4}, NULL, NULL FROM gaps""",
)
ORACLES["set_t0"] = with_(reloc(), f"SELECT rid, {ON_GRID} AS us FROM reloc")
ORACLES["redistribute_time"] = with_(
    reloc()
    + f""",
known AS (
  SELECT *, min(us) OVER (PARTITION BY {BURST}) AS t0, lead(us) OVER w AS us2, lead(x) OVER w AS x2, lead(y) OVER w AS y2
  FROM reloc WHERE x IS NOT NULL WINDOW w AS (PARTITION BY {BURST} ORDER BY us, rid)),
spans AS (SELECT {BURST}, min(us) AS t0, max(us) AS t1 FROM known GROUP BY ALL),
grid AS (SELECT {BURST}, t0, unnest(range(0, (t1 - t0) // {STEP6} + 1)) AS k FROM spans),
met AS (
  SELECT g.*, g.t0 + g.k * {STEP6} AS t, a.us, a.x, a.y, a.us2, a.x2, a.y2
  FROM (SELECT *, t0 + k * {STEP6} AS tt FROM grid) g ASOF JOIN known a
  ON g.pgtraj_name = a.pgtraj_name AND g.burst_name = a.burst_name AND g.tt >= a.us),
placed AS (
  SELECT {BURST}, k + 1 AS rid, t AS us, CASE WHEN us2 IS NULL THEN x ELSE x + (x2 - x) * ((t - us) / CAST(us2 - us AS DOUBLE)) END AS x,
         CASE WHEN us2 IS NULL THEN y ELSE y + (y2 - y) * ((t - us) / CAST(us2 - us AS DOUBLE)) END AS y
  FROM met)""",
    f"SELECT {BURST}, rid, us, {r('x', 'x')}, {r('y', 'y')} FROM placed",
)
ORACLES["subset_params"] = with_(params(), f"SELECT burst_name, seq, rid, {FULL} FROM par WHERE dist < 15")
REGULAR = (
    reloc().replace("reloc AS", "raw AS")
    + f""",
reloc AS (SELECT * REPLACE ({ON_GRID} AS us) FROM raw)"""
)
KEPT = (
    REGULAR
    + f""",
kept AS (SELECT * FROM (SELECT *, min(us) OVER (PARTITION BY {BURST}) AS t0 FROM reloc) WHERE (us - t0) % {8 * HOUR_US} = 0)"""
)
ORACLES["subsample"] = with_(steps(KEPT, base="kept"), "SELECT rid, us, rid2, dt_us FROM step")
ORACLES["recompute"] = with_(params(REGULAR), f"SELECT burst_name, seq, rid, {FULL} FROM par")
# cut: pieces are numbered by the steps over the limit before each relocation, then everything is computed again
CUT = (
    reloc().replace("reloc AS", "raw AS")
    + f""",
far AS (
  SELECT *, CASE WHEN sqrt((lead(x) OVER w - x) ** 2 + (lead(y) OVER w - y) ** 2) > 12 THEN 1 ELSE 0 END AS over_limit
  FROM raw WINDOW w AS (PARTITION BY {BURST} ORDER BY us, rid)),
pieces AS (
  SELECT *, sum(over_limit) OVER (PARTITION BY {BURST} ORDER BY us, rid ROWS UNBOUNDED PRECEDING) - over_limit + 1 AS piece FROM far),
reloc AS (SELECT * REPLACE (concat(burst_name, '.', CAST(piece AS BIGINT)) AS burst_name) FROM pieces)"""
)
ORACLES["cut"] = with_(params(CUT), f"SELECT burst_name, seq, rid, {FULL} FROM par")
ORACLES["bind"] = with_(params(reloc(burst="concat('a', user_id)")), f"SELECT burst_name, seq, rid, {FULL} FROM par")
ORACLES["combine"] = with_(
    reloc()
    + """,
doubled AS (FROM reloc UNION ALL SELECT * REPLACE (concat(burst_name, '-2') AS burst_name) FROM reloc)""",
    """SELECT pgtraj_name, animal_name, burst_name, count(*) AS num_relocations, count(*) - count(x) AS num_na, min(fix_at) AS date_begin,
       max(fix_at) AS date_end FROM doubled GROUP BY 1, 2, 3""",
)
ORACLES["omit_missing"] = with_(
    params(reloc(where="NOT (event_type = 'error' AND event_id % 7 = 0)")), f"SELECT burst_name, seq, rid, {FULL} FROM par"
)
ORACLES["to_type1"] = with_(
    reloc()
    + f""",
placed AS (SELECT *, row_number() OVER (PARTITION BY {BURST} ORDER BY us, rid) AS seq FROM reloc)""",
    f"""SELECT burst_name, seq AS rid, lead(seq) OVER w AS rid2, CAST(NULL AS BIGINT) AS us, lead(x) OVER w AS x2, lead(y) OVER w AS y2
FROM placed WINDOW w AS (PARTITION BY {BURST} ORDER BY seq)""",
)
ORACLES["is_regular"] = with_(
    steps(reloc(DAY))
    + f""",
bursts AS (SELECT {BURST}, coalesce(min(dt_us) = max(dt_us), true) AS same FROM step GROUP BY ALL)""",
    "SELECT pgtraj_name, bool_and(same) AS regular FROM bursts GROUP BY 1",
)

# constant steps: from the current point, the first vertex at least the length away gives the segment to cut
ORACLES["redistribute_space"] = (
    "WITH RECURSIVE "
    + reloc()
    + f""",
vertex AS (SELECT *, row_number() OVER (PARTITION BY {BURST} ORDER BY us, rid) AS k FROM reloc WHERE x IS NOT NULL),
walk AS (
  SELECT {BURST}, CAST(1 AS BIGINT) AS n, x AS cx, y AS cy, CAST(us AS DOUBLE) AS ct, k FROM vertex WHERE k = 1
  UNION ALL
  SELECT {BURST}, n + 1, px + s * (x - px), py + s * (y - py), pt + s * (us - pt), k
  FROM (
    SELECT *, least((sqrt(greatest(b * b - a * c, 0e0)) - b) / a, 1e0) AS s
    FROM (
      SELECT *, (x - px) * (x - px) + (y - py) * (y - py) AS a, (x - px) * (px - cx) + (y - py) * (py - cy) AS b,
             (px - cx) * (px - cx) + (py - cy) * (py - cy) - 16e0 AS c
      FROM (
        SELECT w.pgtraj_name, w.burst_name, w.n, w.cx, w.cy, w.far - 1 AS k, v.x, v.y, v.us,
               CASE WHEN w.far - 1 = w.k THEN w.cx ELSE p.x END AS px, CASE WHEN w.far - 1 = w.k THEN w.cy ELSE p.y END AS py,
               CASE WHEN w.far - 1 = w.k THEN w.ct ELSE p.us END AS pt
        FROM (
          SELECT w.pgtraj_name, w.burst_name, w.n, w.cx, w.cy, w.ct, w.k, min(v.k) AS far
          FROM walk w JOIN vertex v ON w.pgtraj_name = v.pgtraj_name AND w.burst_name = v.burst_name AND v.k > w.k
          WHERE (v.x - w.cx) * (v.x - w.cx) + (v.y - w.cy) * (v.y - w.cy) >= 16e0 * (1e0 - 1e-9)
          GROUP BY ALL) w
        JOIN vertex v ON w.pgtraj_name = v.pgtraj_name AND w.burst_name = v.burst_name AND v.k = w.far
        JOIN vertex p ON w.pgtraj_name = p.pgtraj_name AND w.burst_name = p.burst_name AND p.k = w.far - 1))))
SELECT {BURST}, n AS rid, CAST(round(ct / 1e6) AS BIGINT) AS second, {r("cx", "x")}, {r("cy", "y")} FROM walk"""
)

# -- store, by version and burst
ORACLES["store_import_all"] = with_(
    params(fill="pgtraj") + STORED_INFO,
    f"""SELECT pgtraj_name, seq, x, y, date_trunc('second', fix_at) + INTERVAL 1 HOUR AS date, {r("dist", "dist")}, animal_name AS id,
       burst_name AS burst, i.k, i.status, 'Europe/Paris' AS time_zone FROM par LEFT JOIN info i ON rid = i.event_id""",
)
ORACLES["store_infolocs_by_burst"] = with_(
    params(fill="pgtraj")
    + """,
told AS (SELECT burst_name, seq, fix_at, split_part(burst_name, '-', 2) AS kind, CASE seq % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'high' ELSE 'odd' END AS word FROM par)""",
    """SELECT burst_name AS burst, seq,
       CASE kind WHEN 'view' THEN CAST(CAST(seq AS DOUBLE) AS VARCHAR)
            WHEN 'click' THEN strftime(date_trunc('second', fix_at) + INTERVAL 10 HOUR, '%Y-%m-%d %H:%M:%S')
            WHEN 'purchase' THEN CASE WHEN word <> 'odd' THEN word END WHEN 'error' THEN CASE WHEN word <> 'low' THEN word END ELSE word END AS what,
       CAST(CASE WHEN kind = 'purchase' THEN CASE word WHEN 'low' THEN 1 WHEN 'high' THEN 2 END END AS BIGINT) AS what_level
FROM told""",
)
ORACLES["store_any_names"] = with_(
    params(fill="pgtraj") + STORED_INFO,
    """SELECT concat('Roe-deer no. ', substr(pgtraj_name, 2, 1), ' ''a/b'' ü') AS pgtraj_name,
       count(*) FILTER (x IS NOT NULL AND x2 IS NOT NULL AND i.event_id IS NOT NULL) AS n,
       count(i.k) FILTER (x IS NOT NULL AND x2 IS NOT NULL) AS with_k, count(DISTINCT burst_name) AS num_bursts, count(i.event_id) AS in_table
FROM par LEFT JOIN info i ON rid = i.event_id WHERE pgtraj_name <> 'p1' GROUP BY pgtraj_name""",
)
ORACLES["store_whole_lines"] = with_(
    reloc()
    + f""",
placed AS (SELECT *, {longlat("x", "y")[0]} AS lon, {longlat("x", "y")[1]} AS lat FROM reloc WHERE x IS NOT NULL)""",
    f"""SELECT {BURST}, count(*) OVER (PARTITION BY {BURST}) AS n_points, row_number() OVER (PARTITION BY {BURST} ORDER BY us, rid) AS place,
       {r("lon", "lon", 9)}, {r("lat", "lat", 9)} FROM placed""",
)
ORACLES["store_refresh"] = with_(
    reloc()
    + f""",
kept AS (FROM reloc WHERE pgtraj_name <> 'p3' UNION ALL SELECT * REPLACE ('more' AS pgtraj_name) FROM reloc WHERE pgtraj_name = 'p2'),
way AS (
  SELECT *, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS d FROM kept WHERE x IS NOT NULL
  WINDOW w AS (PARTITION BY {BURST} ORDER BY us, rid)),
lines AS (SELECT {BURST}, count(*) AS n, coalesce(sum(d), 0e0) AS len FROM way GROUP BY ALL),
bursts AS (SELECT {BURST}, count(*) AS num_relocations, count(*) - count(x) AS num_na FROM kept GROUP BY ALL)""",
    f"""SELECT {BURST}, num_relocations, num_na, coalesce(n, 0) AS n_points, {r("len", "length", 6)} FROM bursts LEFT JOIN lines USING ({BURST})""",
)
ORACLES["store_ordered_files"] = with_(
    params(fill="pgtraj"),
    "SELECT pgtraj_name, burst_name AS burst, seq, row_number() OVER (PARTITION BY pgtraj_name ORDER BY burst_name, seq) AS place FROM par",
)
ORACLES["store_ids"] = with_(
    reloc()
    + """,
held AS (SELECT pgtraj_name, burst_name FROM reloc UNION ALL SELECT 'again', burst_name FROM reloc WHERE pgtraj_name = 'p0'),
named AS (FROM held UNION ALL SELECT 'everything', concat(pgtraj_name, burst_name) FROM held)""",
    """SELECT 'steps' AS what, pgtraj_name, count(*) AS n, count(*) AS ids FROM named GROUP BY 2
UNION ALL SELECT 'bursts', pgtraj_name, count(DISTINCT burst_name), count(DISTINCT burst_name) FROM named GROUP BY 2
UNION ALL SELECT 'relocations', 'everything', n, n FROM (SELECT count(*) + count(*) FILTER (pgtraj_name = 'again') AS n FROM held)""",
)

# -- windows by aggregates
ORACLES["window_steps_raw"] = ORACLES["window_steps"]
ORACLES["window_lines_raw"] = ORACLES["window_lines"]
ORACLES["sliding_windows_hourly"] = with_(
    VIEW
    + """,
pages AS (
  SELECT CAST(k AS BIGINT) AS page, TIMESTAMP '2024-01-01' + to_hours(CAST(k AS INTEGER)) AS page_start,
         TIMESTAMP '2024-01-01' + to_hours(CAST(k AS INTEGER) + 720) AS page_end
  FROM range(0, 1500) t(k))""",
    """SELECT pgtraj_name, page, page_start, page_end, count(*) AS num_steps, count(DISTINCT burst_name) AS num_bursts,
       round(sum(dist), 6) AS dist
FROM line JOIN pages ON fix_at >= page_start AND fix_at < page_end GROUP BY 1, 2, 3, 4""",
)
ORACLES["combine_checked"] = with_(
    reloc()
    + """,
doubled AS (FROM reloc UNION ALL SELECT * REPLACE (concat(burst_name, '-2') AS burst_name, concat('q', substr(pgtraj_name, 2)) AS pgtraj_name) FROM reloc)""",
    """SELECT pgtraj_name, animal_name, burst_name, count(*) AS num_relocations, count(*) - count(x) AS num_na, min(fix_at) AS date_begin,
       max(fix_at) AS date_end FROM doubled GROUP BY 1, 2, 3""",
)

# -- refusals, flags and orders
ORACLES["store_refusals"] = """
SELECT what, true AS refused, (SELECT count(*) FROM events) AS steps FROM (VALUES
  ('missing table'), ('missing column'), ('foreign schema'), ('unknown zone'),
  ('no projection'), ('unprojected view'), ('three coordinate columns'), ('text for a system'),
  ('blank name'), ('name of one trajectory twice'), ('import without overwrite'), ('name that begins with a mark'),
  ('burst of several animals'), ('nothing to drop'), ('unknown trajectory'), ('order of a trajectory without times')
) AS t(what)"""
ORACLES["store_failed_overwrite"] = with_(
    params(fill="pgtraj"), f"SELECT fix_at AS date, animal_name, burst_name AS burst, pgtraj_name AS pgtraj, {FULL} FROM par"
)
ORACLES["store_summaries_in_order"] = with_(
    reloc(),
    """SELECT pgtraj_name, burst_name, row_number() OVER (ORDER BY pgtraj_name, burst_name) AS place, CAST(NULL AS BOOLEAN) AS fresh
FROM (SELECT DISTINCT pgtraj_name, burst_name FROM reloc)
UNION ALL SELECT pgtraj_name, NULL, row_number() OVER (ORDER BY pgtraj_name), true FROM (SELECT DISTINCT pgtraj_name FROM reloc)""",
)
ORACLES["export_type_flags"] = with_(
    params()
    + """,
spread AS (SELECT pgtraj_name, burst_name, coalesce(max(dt) - min(dt) < 1e-7, true) AS same, count(*) AS n FROM par GROUP BY ALL)""",
    """SELECT pgtraj_name, true AS type_ii, bool_and(same) AS regular, CAST(sum(n) AS BIGINT) AS n_rows, 'times' AS kind FROM spread GROUP BY 1
UNION ALL SELECT pgtraj_name, false, true, CAST(sum(n) AS BIGINT), 'none' FROM spread GROUP BY 1""",
)
