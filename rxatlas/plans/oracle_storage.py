"""Independent SQL (DuckDB dialect) for the queries over storage."""

from __future__ import annotations

from rxatlas.plans.oracle import (AREAS, CAT, COUNTS, EPD, FLAGS, GROUPED, IDX, ILL, NSPL, NSPL_E, ODS, ORACLE, SPEC, XY, _LONELY, _names,
                                  with_)

_CM = "m.y, m.m, 'EPD_' || m.YEAR_MONTH || CASE WHEN m.m % 3 = 2 THEN '.csv.gz' ELSE '.csv' END AS file"

ORACLE["landed_headers"] = with_(EPD, CAT) + f"""SELECT file, CASE WHEN m % 3 = 1 THEN 9 ELSE 8 END AS n_columns, '' AS missing,
  CASE WHEN m % 3 = 1 THEN 'REGIONAL_OFFICE_NAME' ELSE '' END AS further FROM (SELECT {_CM} FROM cm m)"""

ORACLE["landed_rows_by_file"] = with_(EPD, CAT) + f"""SELECT f.file, e.YEAR_MONTH, count(*) AS n_rows, CAST(sum(ITEMS) AS BIGINT) AS items,
  count(CASE WHEN f.m % 3 = 1 THEN 1 END) AS n_further
  FROM epd e JOIN (SELECT m.YEAR_MONTH, {_CM} FROM cm m) f ON e.YEAR_MONTH = f.YEAR_MONTH GROUP BY 1, 2"""

ORACLE["lookup_columns"] = with_(NSPL, "f AS (SELECT * FROM nspl_raw ORDER BY pcds LIMIT 1)") + "\nUNION ALL\n".join(
    f"""SELECT {k} AS position, '{c}' AS "column", {c} AS first_value FROM f""" for k, c in
    enumerate(("pcds", "lsoa21cd", "msoa21cd", "cty25cd", "lad25cd", "wd25cd")))

# fixed values: the fixture's rings (outer, hole, second part)
ORACLE["boundaries_geojson"] = """WITH v(ring, i, x, y) AS (VALUES
  ('o', 0, 0.0, 0.0), ('o', 1, 9000.0, -500.0), ('o', 2, 18000.0, 2000.0), ('o', 3, 16500.0, 11000.0), ('o', 4, 8000.0, 15000.0),
  ('o', 5, 500.0, 9000.0), ('o', 6, 0.0, 0.0), ('h', 0, 5000.0, 4000.0), ('h', 1, 9000.0, 4500.0), ('h', 2, 7000.0, 8000.0), ('h', 3, 5000.0, 4000.0),
  ('s', 0, 18500.0, 14000.0), ('s', 1, 19500.0, 14500.0), ('s', 2, 19000.0, 16000.0), ('s', 3, 18500.0, 14000.0)),
m AS (SELECT a.ring, CAST(sum(a.x * b.y - b.x * a.y) AS DOUBLE) AS a2, CAST(sum((a.x + b.x) * (a.x * b.y - b.x * a.y)) AS DOUBLE) AS mx,
        CAST(sum((a.y + b.y) * (a.x * b.y - b.x * a.y)) AS DOUBLE) AS my FROM v a JOIN v b ON a.ring = b.ring AND b.i = a.i + 1 GROUP BY a.ring),
n AS (SELECT n_nationkey AS k, (CASE WHEN n_nationkey % 5 = 4 THEN 'W' ELSE 'E' END) || printf('%08d', n_nationkey) AS code,
        (n_nationkey % 5) * 20000.0 + 100.0 * n_nationkey AS x0, (n_nationkey // 5) * 20000.0 + 250.0 * (n_nationkey % 3) AS y0 FROM nation),
t AS (SELECT n.*, CASE ring WHEN 'h' THEN -1 ELSE 1 END AS sgn, m.* FROM n JOIN m ON ring = 'o' OR (ring = 'h' AND k % 3 = 0) OR (ring = 's' AND k % 4 = 0))
SELECT code, CAST(any_value(CASE WHEN k % 4 = 0 THEN 2 ELSE 1 END) AS INTEGER) AS n_parts, CAST(count(*) AS INTEGER) AS n_rings,
  CAST(sum(CASE ring WHEN 'o' THEN 7 ELSE 4 END) AS INTEGER) AS n_vertices,
  round(any_value(CAST(x0 AS DOUBLE)) + sum(sgn * sign(a2) * mx) / (3 * sum(sgn * abs(a2))), 6) AS cx,
  round(any_value(CAST(y0 AS DOUBLE)) + sum(sgn * sign(a2) * my) / (3 * sum(sgn * abs(a2))), 6) AS cy, round(abs(sum(sgn * abs(a2))) / 2, 6) AS area
FROM t WHERE code LIKE 'E%' GROUP BY code"""

ORACLE["prepare_months_state"] = with_(EPD, GROUPED) + """, g AS (
  SELECT printf('EPD_%04d%02d', year, month) AS name, year, month, count(*) AS n_groups, CAST(sum(total_items) AS BIGINT) AS total FROM grouped GROUP BY ALL)
SELECT name, 'committed' AS status, CASE WHEN year = (SELECT max(year) FROM g) AND month <= 6 THEN 2 ELSE 1 END AS n_runs, false AS update_required,
  1 AS n_files, n_groups, total, total AS held FROM g"""

ORACLE["months_to_load"] = with_(EPD, CAT) + """SELECT w.name, c.name IS NOT NULL AS landed,
  CASE WHEN c.name IS NULL OR w.month > 10 THEN 'new' WHEN w.month > 8 THEN 'interrupted' WHEN w.month = 3 THEN 'files_changed' ELSE 'no_partition' END AS reason
FROM wanted w LEFT JOIN cat c USING (name) WHERE c.name IS NULL OR w.month > 8 OR w.month = 3 OR w.month % 4 = 1"""

ORACLE["manifest_log_saved"] = with_(EPD, CAT) + """SELECT dl.name, dl.url,
  CASE WHEN m = 10 THEN NULL WHEN m = 7 THEN make_date(y, m, 29) ELSE make_date(y, m, 28) END AS downloaded, false AS update_required
FROM dl JOIN cat USING (name)"""

ORACLE["period_totals"] = with_(EPD, GROUPED) + """SELECT period, medication, count(DISTINCT ym) AS n_months, CAST(sum(total_items) AS BIGINT) AS total_items
FROM (SELECT * REPLACE (CAST(year AS INTEGER) AS year), CAST(year AS INTEGER) * 100 + month AS ym, CASE WHEN month >= 4 THEN year ELSE year - 1 END AS fy,
        printf('%d/%02d', CASE WHEN month >= 4 THEN year ELSE year - 1 END, (CASE WHEN month >= 4 THEN year + 1 ELSE year END) % 100) AS period FROM grouped)
WHERE fy IN (2015, 2017) GROUP BY 1, 2"""

ORACLE["map_written_by_period"] = with_(EPD, GROUPED, SPEC, NSPL) + f""", m AS (
  SELECT upper(regexp_replace(pcds, '\\s+', '', 'g')) AS postcode, min(lad25cd) AS lad FROM nspl_raw GROUP BY 1)
SELECT g.practice_code, g.year, upper(g.postcode) AS postcode, m.lad,
  CAST(COALESCE(SUM(CASE WHEN g.medication IN {_LONELY} THEN g.total_items END), 0) AS BIGINT) AS total_items,
  CAST(SUM(g.total_items) AS BIGINT) AS grand_total
FROM grouped g LEFT JOIN m ON upper(g.postcode) = m.postcode WHERE g.year = 2015 GROUP BY 1, 2, 3, 4"""

_TYPES = {"pcn_name": "Is Partner To - Name", "sub_icb_name": "Geographic Primary Care Organisation Name", "icb_name": "High Level Health Geography Name",
          "nhser_name": "National Grouping Name", "lsoa21cd": "lsoa21cd", "msoa21cd": "msoa21cd", "county": "cty25cd", "lad": "lad25cd", "ward": "wd25cd"}
ORACLE["map_to_all_areas"] = with_(EPD, GROUPED, SPEC, NSPL, ODS, """j AS (
  SELECT g.*, n.*, o.* FROM grouped g LEFT JOIN nspl_raw n ON upper(g.postcode) = upper(regexp_replace(n.pcds, '\\s+', '', 'g'))
  LEFT JOIN ods_raw o ON g.practice_code = o."Code")""") + "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS area_type, "{c}" AS area, year, CAST(COALESCE(SUM(CASE WHEN medication IN {_LONELY} THEN total_items END), 0) AS BIGINT) AS total_items,
  CAST(SUM(total_items) AS BIGINT) AS grand_total FROM j GROUP BY "{c}", year""" for t, c in _TYPES.items())

ORACLE["area_aggregated_saved"] = ORACLE["area_aggregated"]
ORACLE["illness_dim_saved"] = ORACLE["illness_dim"]

ORACLE["illness_item_flags_exact"] = with_(EPD, SPEC) + "SELECT PRACTICE_CODE, YEAR_MONTH, " + ", ".join(
    f"CAST(SUM(CASE WHEN CHEMICAL_SUBSTANCE_BNF_DESCR IN (SELECT medication FROM dim WHERE illness = '{_names[c]}') THEN ITEMS ELSE 0 END) AS BIGINT) AS {c}"
    for c in ILL) + " FROM epd GROUP BY 1, 2"

ORACLE["illness_item_flags_automaton"] = with_(EPD, SPEC, """texts AS (SELECT DISTINCT BNF_DESCRIPTION AS t FROM epd),
hit AS (SELECT DISTINCT t, illness FROM texts JOIN dim ON contains(lower(t), lower(medication)))""") + "SELECT PRACTICE_CODE, YEAR_MONTH, " + ", ".join(
    f"CAST(SUM(CASE WHEN BNF_DESCRIPTION IN (SELECT t FROM hit WHERE illness = '{_names[c]}') THEN ITEMS ELSE 0 END) AS BIGINT) AS {c}"
    for c in ILL) + " FROM epd GROUP BY 1, 2"

_VINTAGES = """vint(area_type, vintage, f, t) AS (VALUES ('lsoa', '2011', 2011, 2015), ('lsoa', '2021', 2016, 9999), ('msoa', '2011', 2011, 2014),
  ('msoa', '2021', 2015, 9999), ('lad', '2013', -9999, 2013), ('lad', '2015', 2015, 2016), ('ward', '2016', 2016, 2016))"""
_FITTING = "(SELECT arg_max(v.vintage, v.f) FROM vint v WHERE v.area_type = {a} AND {y} BETWEEN v.f AND v.t)"
ORACLE["vintage_check"] = with_(EPD, CAT, _VINTAGES) + """, u AS (
  SELECT o.area_type, o.vintage, yy.y AS year, o.f, o.t FROM (SELECT * FROM vint UNION ALL SELECT 'ward', '1999', NULL, NULL) o, (SELECT DISTINCT y FROM cm) yy)
SELECT area_type, vintage, year, coalesce(year BETWEEN f AND t, false) AS accepted,
  CASE WHEN f IS NULL THEN 'unknown' WHEN year < f THEN 'too_new' WHEN year > t THEN 'too_old' ELSE 'fits' END AS reason, """ + \
    _FITTING.format(a="u.area_type", y="u.year") + " AS fitting FROM u"
ORACLE["vintage_rejects"] = with_(EPD, CAT, _VINTAGES) + """, y AS (SELECT CAST(substr(YEAR_MONTH, 1, 4) AS INTEGER) AS year, count(*) AS n_rows FROM epd GROUP BY 1)
SELECT year, CASE WHEN year < 2015 THEN 'too_new' ELSE 'fits' END AS reason, """ + _FITTING.format(a="'msoa'", y="y.year") + " AS fitting, n_rows FROM y"

ORACLE["practice_points_back"] = with_(EPD, NSPL, NSPL_E) + """, pts AS (
  SELECT DISTINCT e.PRACTICE_CODE, upper(regexp_replace(e.POSTCODE, '\\s+', '', 'g')) AS POSTCODE FROM epd e)
SELECT p.PRACTICE_CODE, p.POSTCODE, round(n.lat, 7) AS lat, round(n.long, 7) AS long, true AS within_mm FROM pts p JOIN nspl_e n USING (POSTCODE)
WHERE isfinite(n.lat) AND isfinite(n.long)"""

ORACLE["month_percentiles_sketched"] = with_(EPD, FLAGS, COUNTS) + ", n AS (" + "\nUNION ALL\n".join(
    f"SELECT YEAR, '{c}' AS illness, count(*) AS n FROM counts WHERE ITEMS <> 0 GROUP BY YEAR" for c in IDX) + """)
SELECT YEAR, illness, CAST(p AS DOUBLE) AS p, n, true AS within FROM n, (VALUES (0.005), (0.5), (0.995)) t(p)"""

ORACLE["practice_area_distance_all"] = with_(XY, AREAS) + """SELECT t.code, xy.PRACTICE_CODE,
  round(sqrt((xy.x - t.tx) * (xy.x - t.tx) + (xy.y - t.ty) * (xy.y - t.ty)), 6) AS distance FROM xy, targets t"""


def _boxes(changed: bool) -> str:
    moved = "CASE WHEN k IN (1, 2) THEN {} ELSE 0 END" if changed else "0 * {}"
    rows = "SELECT s_suppkey AS k FROM supplier" + (" WHERE s_suppkey <> 3 UNION ALL SELECT 1000003" if changed else "")
    return f"""WITH b AS (
  SELECT 'A' || k AS code, 1000.0 * ((k * 37) % 101) + {moved.format("3000.0")} AS x, 1000.0 * ((k * 53) % 97) + {moved.format("7000.0")} AS y,
    50.0 * 2 ** (k % 11) AS s FROM ({rows})
  UNION ALL SELECT 'R' || r_regionkey, -100000.0 + 10000.0 * r_regionkey, -100000.0 - 10000.0 * r_regionkey, 1000000.0 FROM region)
SELECT a.code, b.code AS nb FROM b a JOIN b ON a.x <= b.x + b.s AND b.x <= a.x + a.s AND a.y <= b.y + b.s AND b.y <= a.y + a.s"""


ORACLE["area_neighbours_mixed"] = _boxes(False)
ORACLE["area_neighbours_updated"] = _boxes(True)
