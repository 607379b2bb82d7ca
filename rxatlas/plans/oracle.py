"""Independent SQL (DuckDB dialect) for every registered query.

Written from the query semantics, not from the Spark code: views over the
driver tables as in FIXTURES.md part B, then plain SQL. Doubles are rounded
to 6 digits (3 for projected metres), as on the Spark side.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ILL = ["depression", "alzheimers", "blood_pressure", "insomnia", "social_anxiety",
       "diabetes", "addiction"]
IDX = ILL[:5]
PATTERNS = {"depression": "Ring|Widget", "alzheimers": "Bolt", "blood_pressure": "Rod",
            "insomnia": "Plate", "social_anxiety": "Ring", "diabetes": "Anvil", "addiction": "Gear"}


def r6(e, a, d=6):
    return f"round({e}, {d}) AS {a}"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def cap(w):
    return f"upper(substr({w}, 1, 1)) || substr({w}, 2)"


EPD = f"""epd AS (
  SELECT printf('Y%05d', l_suppkey) AS PRACTICE_CODE,
         'ab' || CAST(l_suppkey // 10 AS VARCHAR) || ' ' || CAST(l_suppkey % 10 AS VARCHAR) || 'cd' AS POSTCODE,
         CAST((year(l_shipdate) + 20) * 100 + month(l_shipdate) AS VARCHAR) AS YEAR_MONTH,
         {cap("split_part(p_name, ' ', 1)")} || ' ' || {cap("split_part(p_name, ' ', 2)")} AS CHEMICAL_SUBSTANCE_BNF_DESCR,
         p_name || ' ' || p_type || ' ' || CAST(p_size AS VARCHAR) || 'mg' AS BNF_DESCRIPTION,
         CAST(l_quantity AS BIGINT) AS ITEMS,
         CAST(l_quantity AS DOUBLE) * p_size AS TOTAL_QUANTITY,
         CAST(l_extendedprice AS DOUBLE) AS ACTUAL_COST
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

LAD = "(CASE WHEN s_nationkey % 5 = 4 THEN 'W' ELSE 'E' END) || printf('%08d', s_nationkey)"
NSPL = f"""nspl_raw AS (
  SELECT 'AB' || CAST(s_suppkey // 10 AS VARCHAR) || ' ' || CAST(s_suppkey % 10 AS VARCHAR) || 'CD' AS pcds,
         50 + ((s_suppkey * 37) % 101) / 20.0::DOUBLE AS lat,
         -5 + ((s_suppkey * 53) % 97) / 20.0::DOUBLE AS long,
         {LAD} || '-' || CAST(s_suppkey % 3 AS VARCHAR) || '-' || CAST(s_suppkey % 2 AS VARCHAR) AS lsoa21cd,
         {LAD} || '-' || CAST(s_suppkey % 3 AS VARCHAR) AS msoa21cd,
         'C' || CAST(s_nationkey % 5 AS VARCHAR) AS cty25cd,
         {LAD} AS lad25cd,
         'W' || CAST(s_suppkey % 7 AS VARCHAR) AS wd25cd
  FROM supplier WHERE s_suppkey % 10 <> 9)"""
NSPL_E = """nspl_e AS (
  SELECT upper(regexp_replace(pcds, '\\s+', '', 'g')) AS POSTCODE, lat, long, msoa21cd AS msoa11, lad25cd AS laua
  FROM nspl_raw WHERE lad25cd LIKE 'E%')"""
ODS = """ods_raw AS (
  SELECT printf('Y%05d', s_suppkey) AS "Code",
         CASE WHEN s_suppkey % 10 <> 9 THEN 'PCN ' || CAST(s_suppkey % 8 AS VARCHAR) END AS "Is Partner To - Name",
         n_name AS "Geographic Primary Care Organisation Name",
         'ICB ' || CAST(n_nationkey % 10 AS VARCHAR) AS "High Level Health Geography Name",
         r_name AS "National Grouping Name"
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
XY = """xy AS (
  SELECT printf('Y%05d', s_suppkey) AS PRACTICE_CODE,
         1000.0 * ((s_suppkey * 37) % 101) AS x, 1000.0 * ((s_suppkey * 53) % 97) AS y
  FROM supplier WHERE s_suppkey % 10 <> 9)"""
AREAS = """areas AS (
  SELECT (CASE WHEN n_nationkey % 5 = 4 THEN 'W' ELSE 'E' END) || printf('%08d', n_nationkey) AS code,
         n_nationkey % 5 AS col, n_nationkey // 5 AS row, n_regionkey
  FROM nation),
areas_e AS (SELECT * FROM areas WHERE code LIKE 'E%'),
targets AS (SELECT code, 20000.0 * col + 10000.0 AS tx, 20000.0 * row + 10000.0 AS ty FROM areas_e)"""
SPEC = """spec(illness, tag, noun) AS (VALUES
  ('Depression', 'Loneliness', 'Ring'), ('Depression', 'Loneliness', 'Widget'),
  ('Alzheimers', 'Loneliness', 'Bolt'), ('Blood Pressure', 'Loneliness', 'Rod'),
  ('Insomnia', 'Loneliness', 'Plate'), ('Social Anxiety', 'Loneliness', 'Ring'),
  ('Diabetes', NULL, 'Anvil'), ('Addiction', NULL, 'Gear')),
names AS (SELECT DISTINCT {n1} || ' ' || {n2} AS medication, {n2} AS noun FROM part),
dim AS (SELECT s.illness, s.tag, n.medication FROM spec s JOIN names n ON s.noun = n.noun)""".format(
    n1=cap("split_part(p_name, ' ', 1)"), n2=cap("split_part(p_name, ' ', 2)"))
GROUPED = """grouped AS (
  SELECT PRACTICE_CODE AS practice_code, regexp_replace(POSTCODE, '\\s+', '', 'g') AS postcode,
         CHEMICAL_SUBSTANCE_BNF_DESCR AS medication,
         CAST(substr(YEAR_MONTH, 1, 4) AS SMALLINT) AS year, CAST(substr(YEAR_MONTH, 5, 2) AS TINYINT) AS month,
         CAST(COALESCE(SUM(ITEMS), 0) AS BIGINT) AS total_items
  FROM epd GROUP BY ALL)"""

_flag_cols = ",\n         ".join(
    f"CASE WHEN regexp_matches(BNF_DESCRIPTION, '{PATTERNS[c]}', 'i') THEN ITEMS ELSE 0 END AS {c}" for c in ILL)
FLAGS = f"""flags AS (
  SELECT PRACTICE_CODE, upper(regexp_replace(POSTCODE, '\\s+', '', 'g')) AS POSTCODE,
         substr(YEAR_MONTH, 1, 4) AS YEAR, substr(YEAR_MONTH, 5) AS MONTH,
         {_flag_cols},
         ITEMS
  FROM epd)"""
_sum7 = ", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in ILL)
COUNTS = f"""counts AS (
  SELECT PRACTICE_CODE, YEAR, MONTH, POSTCODE, {_sum7}, CAST(SUM(ITEMS) AS BIGINT) AS ITEMS
  FROM flags WHERE PRACTICE_CODE IS NOT NULL AND YEAR IS NOT NULL AND MONTH IS NOT NULL AND POSTCODE IS NOT NULL
  GROUP BY PRACTICE_CODE, YEAR, MONTH, POSTCODE)"""
KEPT = f"""kept AS (
  SELECT * FROM counts
  WHERE {" + ".join(ILL)} >= 100 AND {" + ".join(c for c in ILL if c != "addiction")} >= addiction)"""
_sum5 = ", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in IDX)


def year_counts(cols=IDX):
    s = ", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in cols)
    return f"""ycounts AS (
  SELECT PRACTICE_CODE, YEAR, POSTCODE, {s}, CAST(SUM(ITEMS) AS BIGINT) AS ITEMS
  FROM kept GROUP BY PRACTICE_CODE, YEAR, POSTCODE)"""


def pct(cols=IDX):
    p = ", ".join(f"CASE WHEN ITEMS = 0 THEN NULL ELSE (100.0::DOUBLE * {c}) / ITEMS END AS {c}_perc" for c in cols)
    return f"pct AS (SELECT *, {p} FROM ycounts)"


def quant(cols=IDX):
    q = ", ".join(f"quantile_cont({c}_perc, 0.005) AS {c}__lower, quantile_cont({c}_perc, 0.995) AS {c}__upper"
                  for c in cols)
    return f"quant AS (SELECT YEAR, {q} FROM pct GROUP BY YEAR)"


def clip(cols=IDX):
    t = ", ".join(f"CASE WHEN {c}_perc IS NULL THEN NULL ELSE least(greatest({c}_perc, {c}__lower), {c}__upper) END "
                  f"AS {c}_perc_trim" for c in cols)
    return f"clip AS (SELECT pct.*, {t} FROM pct LEFT JOIN quant USING (YEAR))"


def zs(cols=IDX):
    st = ", ".join(f"avg({c}_perc_trim) AS {c}__mean, stddev_pop({c}_perc_trim) AS {c}__std" for c in cols)
    z = ", ".join(f"({c}_perc_trim - {c}__mean) / NULLIF({c}__std, 0) AS {c}_perc_trim_zscore" for c in cols)
    total = " + ".join(f"COALESCE({c}_perc_trim_zscore, 0)" for c in cols)
    return (f"zstat AS (SELECT YEAR, {st} FROM clip GROUP BY YEAR),\n"
            f"z AS (SELECT clip.*, {z} FROM clip LEFT JOIN zstat USING (YEAR)),\n"
            f"pidx AS (SELECT *, {total} AS loneliness_prac FROM z)")


def index_ctes(cols=IDX):
    return [EPD, FLAGS, COUNTS, KEPT, year_counts(cols), pct(cols), quant(cols), clip(cols), zs(cols)]


def pidx_cols(cols=IDX, rounded=True):
    out = ["PRACTICE_CODE", "YEAR", "POSTCODE"] + cols + ["ITEMS"]
    dbl = [f"{c}_perc" for c in cols] + [f"{c}_perc_trim" for c in cols] + \
        [f"{c}_perc_trim_zscore" for c in cols] + ["loneliness_prac"]
    return out + ([r6(c, c) for c in dbl] if rounded else dbl)


YEARS = "years AS (SELECT DISTINCT YEAR FROM pidx)"
SPINE = "spine AS (SELECT a.code, y.YEAR FROM areas_e a, years y)"
SOURCES = """sources AS (SELECT p.YEAR, p.PRACTICE_CODE, p.loneliness_prac AS v, xy.x, xy.y
                         FROM pidx p JOIN xy USING (PRACTICE_CODE))"""
PAIRS = """pairs AS (
  SELECT s.YEAR, t.code, s.PRACTICE_CODE, s.v, (s.x - t.tx) * (s.x - t.tx) + (s.y - t.ty) * (s.y - t.ty) AS d2
  FROM sources s, targets t),
ranked AS (SELECT *, rank() OVER (PARTITION BY YEAR, code ORDER BY d2) AS rk FROM pairs)"""


def idw_of(kept: str, keys="YEAR, code"):
    return f"""SELECT {keys},
    CASE WHEN bool_or(d2 = 0) THEN NULL
         ELSE SUM(v / sqrt(d2)) / SUM(1.0 / sqrt(d2)) END AS loneliness
  FROM {kept} GROUP BY {keys}"""


GEO = index_ctes() + [XY, AREAS, YEARS, SPINE, SOURCES, PAIRS]
INTERP = f"""interp AS (
  SELECT spine.YEAR, spine.code, i.loneliness FROM spine
  LEFT JOIN ({idw_of("(SELECT * FROM ranked WHERE rk <= 5)")}) i USING (YEAR, code))"""
NEIGH = """neigh AS (
  SELECT a.code, b.code AS nb FROM areas_e a JOIN areas_e b
  ON abs(a.col - b.col) <= 1 AND abs(a.row - b.row) <= 1)"""
LISA = """flag AS (SELECT YEAR, code, COALESCE(loneliness >= 0, false) AS hi FROM interp),
lisa AS (
  SELECT f.YEAR, n.code, AVG(CASE WHEN f.hi = COALESCE(g.hi, false) THEN 1.0 ELSE 0.0 END) AS LISA_score,
         COUNT(*) AS LISA_support
  FROM neigh n JOIN flag f ON f.code = n.code
  LEFT JOIN flag g ON g.code = n.nb AND g.YEAR = f.YEAR
  GROUP BY f.YEAR, n.code),
result AS (SELECT interp.*, lisa.LISA_score, lisa.LISA_support FROM interp LEFT JOIN lisa USING (YEAR, code))"""

AREA_MEAN = f"""geo AS (SELECT pidx.*, n.lat, n.long, n.msoa11, n.laua FROM pidx LEFT JOIN nspl_e n USING (POSTCODE)),
g AS (
  SELECT YEAR, laua AS code, {", ".join(f"avg({c}_perc_trim_zscore) AS {c}_perc_trim_zscore" for c in IDX)},
         CAST(SUM(ITEMS) AS BIGINT) AS ITEMS
  FROM geo WHERE laua IS NOT NULL GROUP BY YEAR, laua),
amean AS (
  SELECT spine.YEAR, spine.code, {" + ".join(f"COALESCE(g.{c}_perc_trim_zscore, 0)" for c in IDX)} AS loneliness0,
         g.ITEMS, {", ".join(f"g.{c}_perc_trim_zscore" for c in IDX)}, g.code IS NOT NULL AS has
  FROM spine LEFT JOIN g USING (YEAR, code))"""
AMEAN_SEL = "CASE WHEN has THEN loneliness0 END"

# ---- scan / shape ---------------------------------------------------------------

ORACLE["scan_epd_typed"] = with_(EPD) + f"""SELECT PRACTICE_CODE, POSTCODE, YEAR_MONTH, CHEMICAL_SUBSTANCE_BNF_DESCR,
  BNF_DESCRIPTION, ITEMS, {r6("TOTAL_QUANTITY", "TOTAL_QUANTITY")}, {r6("ACTUAL_COST", "ACTUAL_COST")} FROM epd"""

ORACLE["epd_year_slice"] = with_(EPD) + """SELECT substr(YEAR_MONTH, 1, 4) AS slice_year, COUNT(*) AS n_rows,
  COUNT(DISTINCT YEAR_MONTH) AS n_months, CAST(SUM(ITEMS) AS BIGINT) AS items FROM epd GROUP BY 1"""

ORACLE["postcode_norm"] = with_(EPD) + """SELECT DISTINCT POSTCODE AS raw_postcode, regexp_replace(POSTCODE, '\\s+', '', 'g') AS no_space,
  replace(POSTCODE, ' ', '') AS no_blank, upper(regexp_replace(POSTCODE, '\\s+', '', 'g')) AS postcode FROM epd"""

ORACLE["year_month_parts"] = with_(EPD) + """SELECT DISTINCT YEAR_MONTH, CAST(substr(YEAR_MONTH, 1, 4) AS SMALLINT) AS year,
  CAST(substr(YEAR_MONTH, 5, 2) AS TINYINT) AS month, substr(YEAR_MONTH, 1, 4) AS year_text, substr(YEAR_MONTH, 5) AS month_text,
  'EPD_' || YEAR_MONTH AS name FROM epd"""

ORACLE["nspl_england"] = with_(NSPL, NSPL_E) + f"""SELECT POSTCODE, {r6("lat", "lat")}, {r6("long", "long")}, msoa11, laua
  FROM nspl_e"""

ORACLE["nspl_select"] = with_(NSPL) + f"""SELECT upper(regexp_replace(pcds, '\\s+', '', 'g')) AS postcode,
  {r6("lat", "lat")}, {r6("long", "long")}, lsoa21cd, msoa21cd, cty25cd AS county, lad25cd AS lad, wd25cd AS ward
  FROM nspl_raw"""

ORACLE["ods_select"] = with_(ODS) + """SELECT "Code" AS practice_code, "Is Partner To - Name" AS pcn_name,
  "Geographic Primary Care Organisation Name" AS sub_icb_name, "High Level Health Geography Name" AS icb_name,
  "National Grouping Name" AS nhser_name FROM ods_raw"""

ORACLE["england_areas"] = with_(AREAS) + """SELECT code, 1 AS n_parts, 5 AS n_vertices,
  round(20000.0 * col, 6) AS minx, round(20000.0 * row, 6) AS miny,
  round(20000.0 * col + 20000.0, 6) AS maxx, round(20000.0 * row + 20000.0, 6) AS maxy FROM areas_e"""

# Target name and source column, as in the lookups.
_nspl_map = [("postcode", "pcds"), ("lat", "lat"), ("long", "long"), ("lsoa21cd", "lsoa21cd"),
             ("msoa21cd", "msoa21cd"), ("county", "cty25cd"), ("lad", "lad25cd"), ("ward", "wd25cd")]
_ods_map = [("practice_code", "Code"), ("pcn_name", "Is Partner To - Name"),
            ("sub_icb_name", "Geographic Primary Care Organisation Name"),
            ("icb_name", "High Level Health Geography Name"), ("nhser_name", "National Grouping Name")]
ORACLE["schema_contract"] = with_(NSPL, ODS) + "\nUNION ALL\n".join(
    [f"""SELECT 'nspl' AS lookup, '{d}' AS target, '{s}' AS source, true AS present, COUNT("{s}") AS non_null
         FROM nspl_raw""" for d, s in _nspl_map] +
    [f"""SELECT 'ods' AS lookup, '{d}' AS target, '{s}' AS source, true AS present, COUNT("{s}") AS non_null
         FROM ods_raw""" for d, s in _ods_map])

# ---- grouping -----------------------------------------------------------------------

ORACLE["month_items"] = with_(EPD, GROUPED) + "SELECT * FROM grouped"


def _month_measure(measure, med):
    return with_(EPD) + f"""SELECT PRACTICE_CODE AS practice_code, regexp_replace(POSTCODE, '\\s+', '', 'g') AS postcode,
  {med} AS medication, CAST(substr(YEAR_MONTH, 1, 4) AS SMALLINT) AS year,
  CAST(substr(YEAR_MONTH, 5, 2) AS TINYINT) AS month, round(COALESCE(SUM({measure}), 0), 6) AS total_items
  FROM epd GROUP BY ALL"""


ORACLE["month_quantity"] = _month_measure("TOTAL_QUANTITY", "CHEMICAL_SUBSTANCE_BNF_DESCR")
ORACLE["month_cost"] = _month_measure("ACTUAL_COST", "BNF_DESCRIPTION")
ORACLE["grouped_roundtrip"] = ORACLE["month_items"]
ORACLE["month_reprocess"] = with_(EPD, GROUPED) + """SELECT * FROM grouped
  WHERE NOT (month % 2 = 0 AND medication LIKE '%Gizmo')"""
ORACLE["year_medication_totals"] = with_(EPD, GROUPED) + """SELECT year, medication,
  CAST(SUM(total_items) AS BIGINT) AS total_items FROM grouped GROUP BY year, medication"""

ORACLE["analyst_year_totals"] = with_(EPD, GROUPED) + """SELECT year, medication,
  CAST(SUM(total_items) AS BIGINT) AS total_items FROM grouped WHERE year = 2015 GROUP BY year, medication"""

# ---- dimension ----------------------------------------------------------------------

ORACLE["illness_dim"] = with_(SPEC) + "SELECT illness, COALESCE(tag, '') AS tags, medication FROM dim"
ORACLE["dim_tags"] = with_(SPEC) + "SELECT DISTINCT tag FROM dim WHERE tag IS NOT NULL"
ORACLE["dim_illnesses"] = with_(SPEC) + "SELECT DISTINCT illness FROM dim"
ORACLE["meds_all"] = with_(SPEC) + "SELECT DISTINCT medication FROM dim"
ORACLE["meds_by_tag"] = with_(SPEC) + "SELECT DISTINCT medication FROM dim WHERE tag = 'Loneliness'"
ORACLE["meds_by_illness"] = with_(SPEC) + "SELECT DISTINCT medication FROM dim WHERE illness = 'Social Anxiety'"
ORACLE["illness_by_tag"] = with_(SPEC) + "SELECT DISTINCT illness FROM dim WHERE tag = 'Loneliness'"
ORACLE["meds_filter_totals"] = with_(EPD, GROUPED, SPEC) + """SELECT year, medication,
  CAST(SUM(total_items) AS BIGINT) AS total_items FROM grouped
  WHERE medication IN (SELECT medication FROM dim WHERE tag = 'Loneliness') GROUP BY year, medication"""
ORACLE["meds_filter_year_totals"] = with_(EPD, GROUPED, SPEC) + """SELECT year, medication,
  CAST(SUM(total_items) AS BIGINT) AS total_items FROM grouped
  WHERE year = 2015 AND medication IN (SELECT medication FROM dim WHERE tag = 'Loneliness') GROUP BY year, medication"""
ORACLE["illness_medication_totals"] = with_(EPD, GROUPED, SPEC) + """SELECT d.illness, g.year,
  CAST(SUM(g.total_items) AS BIGINT) AS total_items, COUNT(DISTINCT g.medication) AS n_medications
  FROM grouped g JOIN (SELECT DISTINCT illness, medication FROM dim) d ON g.medication = d.medication
  GROUP BY d.illness, g.year"""

# ---- practice index ------------------------------------------------------------------

ORACLE["illness_item_flags"] = with_(EPD, FLAGS) + "SELECT * FROM flags"
_names = {"depression": "Depression", "alzheimers": "Alzheimers", "blood_pressure": "Blood Pressure",
          "insomnia": "Insomnia", "social_anxiety": "Social Anxiety", "diabetes": "Diabetes",
          "addiction": "Addiction"}
ORACLE["illness_totals"] = with_(EPD, FLAGS) + "\nUNION ALL\n".join(
    f"SELECT '{_names[c]}' AS illness, CAST(SUM({c}) AS BIGINT) AS items FROM flags" for c in ILL)
ORACLE["practice_month_counts"] = with_(EPD, FLAGS, COUNTS) + "SELECT * FROM counts"
ORACLE["practice_month_kept"] = with_(EPD, FLAGS, COUNTS, KEPT) + "SELECT * FROM kept"
ORACLE["practice_year_counts"] = with_(EPD, FLAGS, COUNTS, KEPT, year_counts()) + "SELECT * FROM ycounts"
ORACLE["illness_percent"] = with_(EPD, FLAGS, COUNTS, KEPT, year_counts(), pct()) + \
    "SELECT PRACTICE_CODE, YEAR, POSTCODE, " + ", ".join(IDX) + ", ITEMS, " + \
    ", ".join(r6(f"{c}_perc", f"{c}_perc") for c in IDX) + " FROM pct"
ORACLE["illness_quantiles"] = with_(EPD, FLAGS, COUNTS, KEPT, year_counts(), pct(), quant()) + \
    "\nUNION ALL\n".join(f"SELECT YEAR, '{c}' AS illness, {r6(f'{c}__lower', 'lower')}, "
                         f"{r6(f'{c}__upper', 'upper')} FROM quant" for c in IDX)
ORACLE["illness_clip"] = with_(EPD, FLAGS, COUNTS, KEPT, year_counts(), pct(), quant(), clip()) + \
    "SELECT PRACTICE_CODE, YEAR, POSTCODE, " + ", ".join(IDX) + ", ITEMS, " + \
    ", ".join(r6(f"{c}_perc", f"{c}_perc") for c in IDX) + ", " + \
    ", ".join(r6(f"{c}_perc_trim", f"{c}_perc_trim") for c in IDX) + " FROM clip"
ORACLE["illness_zscore"] = with_(*index_ctes()) + "SELECT " + ", ".join(
    c if not c.startswith("round") else c for c in pidx_cols()[:-1]) + " FROM pidx"
ORACLE["practice_index"] = with_(*index_ctes()) + "SELECT " + ", ".join(pidx_cols()) + " FROM pidx"
ORACLE["practice_index_geo"] = with_(*index_ctes(), NSPL, NSPL_E) + "SELECT " + ", ".join(
    pidx_cols()) + ", " + r6("n.lat", "lat") + ", " + r6("n.long", "long") + \
    ", n.msoa11, n.laua FROM pidx LEFT JOIN nspl_e n USING (POSTCODE)"
ORACLE["practice_index_saved"] = with_(*index_ctes(), NSPL, NSPL_E) + "SELECT PRACTICE_CODE, YEAR, POSTCODE, ITEMS, " + \
    r6("loneliness_prac", "loneliness_prac") + ", n.laua AS code FROM pidx LEFT JOIN nspl_e n USING (POSTCODE)"
ORACLE["single_illness_index"] = with_(*index_ctes(["depression"])) + \
    "SELECT PRACTICE_CODE, YEAR, POSTCODE, " + r6("depression_perc_trim_zscore", "depression_perc_trim_zscore") + \
    ", " + r6("loneliness_prac", "loneliness_prac") + " FROM pidx"

# ---- areas ----------------------------------------------------------------------------

_AREA = index_ctes() + [NSPL, NSPL_E, AREAS, YEARS, SPINE, AREA_MEAN]
ORACLE["area_mean_index"] = with_(*_AREA) + f"""SELECT YEAR, code, {r6(AMEAN_SEL, "loneliness")}, ITEMS,
  {", ".join(r6(f"{c}_perc_trim_zscore", f"{c}_perc_trim_zscore") for c in IDX)} FROM amean"""
ORACLE["area_support"] = with_(*_AREA) + "SELECT YEAR, code, ITEMS FROM amean"
ORACLE["area_aggregated"] = with_(*_AREA) + f"SELECT YEAR, code, {r6(AMEAN_SEL, 'loneliness')}, ITEMS FROM amean"
ORACLE["quantile_classes"] = with_(*_AREA) + f""", v AS (SELECT YEAR, code, {AMEAN_SEL} AS loneliness FROM amean),
br AS (SELECT YEAR, quantile_cont(loneliness, [0.2, 0.4, 0.6, 0.8, 1.0]) AS b FROM v GROUP BY YEAR),
c AS (SELECT v.*, 1 + (SELECT COUNT(*) FROM unnest(br.b) t(x) WHERE x < v.loneliness) AS cls
      FROM v LEFT JOIN br USING (YEAR))
SELECT YEAR, code, {r6("loneliness", "loneliness")},
  CASE WHEN loneliness IS NULL THEN NULL ELSE CAST(cls AS INTEGER) END AS class,
  CASE WHEN loneliness IS NULL THEN 'Missing values' ELSE 'Q' || CAST(cls AS VARCHAR) END AS label FROM c"""

_LONELY = "(SELECT medication FROM dim WHERE tag = 'Loneliness')"
ORACLE["map_to_postcode_area"] = with_(EPD, GROUPED, SPEC, NSPL) + f""", m AS (
  SELECT upper(regexp_replace(pcds, '\\s+', '', 'g')) AS postcode, min(lad25cd) AS lad FROM nspl_raw GROUP BY 1)
SELECT g.practice_code, g.year, upper(g.postcode) AS postcode, m.lad,
  CAST(COALESCE(SUM(CASE WHEN g.medication IN {_LONELY} THEN g.total_items END), 0) AS BIGINT) AS total_items,
  CAST(SUM(g.total_items) AS BIGINT) AS grand_total
FROM grouped g LEFT JOIN m ON upper(g.postcode) = m.postcode GROUP BY 1, 2, 3, 4"""
ORACLE["map_to_practice_area"] = with_(EPD, GROUPED, SPEC, ODS) + f""", m AS (
  SELECT "Code" AS practice_code, min("Is Partner To - Name") AS pcn_name FROM ods_raw GROUP BY 1)
SELECT g.practice_code, g.year, g.postcode, m.pcn_name,
  CAST(COALESCE(SUM(CASE WHEN g.medication IN {_LONELY} THEN g.total_items END), 0) AS BIGINT) AS total_items,
  CAST(SUM(g.total_items) AS BIGINT) AS grand_total
FROM grouped g LEFT JOIN m USING (practice_code) GROUP BY 1, 2, 3, 4"""

# ---- geometry ---------------------------------------------------------------------------


def bng_sql(src: str) -> str:
    """The published steps written out once more: ``src`` (lat, long) with bng_x, bng_y."""
    return f"""SELECT * FROM (
  WITH c AS (SELECT 6378137.0::DOUBLE AS a1, 6356752.314245::DOUBLE AS b1, 6377563.396::DOUBLE AS a2, 6356256.909::DOUBLE AS b2,
      0.9996012717::DOUBLE AS f0, radians(49.0::DOUBLE) AS p0, radians(-2.0::DOUBLE) AS l0, 1.0::DOUBLE + 20.4894::DOUBLE / 1000000 AS sc,
      radians(-0.1502::DOUBLE / 3600) AS rx, radians(-0.2470::DOUBLE / 3600) AS ry, radians(-0.8421::DOUBLE / 3600) AS rz),
  k AS (SELECT *, (a1 * a1 - b1 * b1) / (a1 * a1) AS e1, (a2 * a2 - b2 * b2) / (a2 * a2) AS e2, (a2 - b2) / (a2 + b2) AS n FROM c),
  g AS (SELECT s.*, k.*, radians(s.lat) AS p, radians(s.long) AS l FROM {src} s, k),
  w AS (SELECT *, a1 / sqrt(1 - e1 * sin(p) ** 2) AS v FROM g),
  x AS (SELECT *, v * cos(p) * cos(l) AS cx, v * cos(p) * sin(l) AS cy, v * (1 - e1) * sin(p) AS cz FROM w),
  h AS (SELECT *, sc * cx - rz * cy + ry * cz - 446.448 AS hx, rz * cx + sc * cy - rx * cz + 125.157 AS hy,
      sc * cz + rx * cy - ry * cx - 542.060 AS hz FROM x),
  q0 AS (SELECT *, sqrt(hx * hx + hy * hy) AS d, atan2(hy, hx) - l0 AS dl, atan2(hz, sqrt(hx * hx + hy * hy) * (1 - e2)) AS f0th FROM h),
  q1 AS (SELECT *, atan2(hz + e2 * a2 / sqrt(1 - e2 * sin(f0th) ** 2) * sin(f0th), d) AS f1st FROM q0),
  q2 AS (SELECT *, atan2(hz + e2 * a2 / sqrt(1 - e2 * sin(f1st) ** 2) * sin(f1st), d) AS f2nd FROM q1),
  q3 AS (SELECT *, atan2(hz + e2 * a2 / sqrt(1 - e2 * sin(f2nd) ** 2) * sin(f2nd), d) AS f3rd FROM q2),
  q4 AS (SELECT *, atan2(hz + e2 * a2 / sqrt(1 - e2 * sin(f3rd) ** 2) * sin(f3rd), d) AS f FROM q3),
  r AS (SELECT *, a2 * f0 / sqrt(1 - e2 * sin(f) ** 2) AS nu, a2 * f0 * (1 - e2) * (1 - e2 * sin(f) ** 2) ** (-1.5) AS rho,
      b2 * f0 * ((1 + n + 5 * n ** 2 / 4 + 5 * n ** 3 / 4) * (f - p0) - (3 * n + 3 * n ** 2 + 21 * n ** 3 / 8) * sin(f - p0) * cos(f + p0)
        + (15 * n ** 2 / 8 + 15 * n ** 3 / 8) * sin(2 * (f - p0)) * cos(2 * (f + p0)) - 35 * n ** 3 / 24 * sin(3 * (f - p0)) * cos(3 * (f + p0))) AS m
      FROM q4),
  u AS (SELECT *, nu / rho - 1 AS eta, tan(f) ** 2 AS t2 FROM r)
  SELECT * EXCLUDE (a1, b1, a2, b2, f0, p0, l0, sc, rx, ry, rz, e1, e2, n, p, l, v, cx, cy, cz, hx, hy, hz, d, f0th, f1st, f2nd, f3rd),
    400000 + nu * cos(f) * dl + nu / 6 * cos(f) ** 3 * (nu / rho - t2) * dl ** 3
      + nu / 120 * cos(f) ** 5 * (5 - 18 * t2 + t2 ** 2 + 14 * eta - 58 * t2 * eta) * dl ** 5 AS bng_x,
    m - 100000 + nu / 2 * sin(f) * cos(f) * dl ** 2 + nu / 24 * sin(f) * cos(f) ** 3 * (5 - t2 + 9 * eta) * dl ** 4
      + nu / 720 * sin(f) * cos(f) ** 5 * (61 - 58 * t2 + t2 ** 2) * dl ** 6 AS bng_y
  FROM u)"""


ORACLE["practice_points"] = with_(EPD, NSPL, NSPL_E) + f""", pts AS (
  SELECT DISTINCT e.PRACTICE_CODE, upper(regexp_replace(e.POSTCODE, '\\s+', '', 'g')) AS POSTCODE FROM epd e),
j AS (SELECT p.PRACTICE_CODE, p.POSTCODE, n.lat, n.long FROM pts p JOIN nspl_e n USING (POSTCODE)
      WHERE n.lat IS NOT NULL AND n.long IS NOT NULL AND isfinite(n.lat) AND isfinite(n.long))
SELECT PRACTICE_CODE, POSTCODE, round(bng_x, 3) AS x, round(bng_y, 3) AS y FROM ({bng_sql("j")})"""

ORACLE["area_centroids"] = with_(AREAS) + """SELECT code, round(tx, 6) AS cx, round(ty, 6) AS cy,
  round(400000000.0, 6) AS area FROM targets"""

ORACLE["practice_area_distance"] = with_(XY, AREAS) + """SELECT t.code, xy.PRACTICE_CODE,
  round(sqrt((xy.x - t.tx) * (xy.x - t.tx) + (xy.y - t.ty) * (xy.y - t.ty)), 6) AS distance
  FROM xy, targets t WHERE (xy.x - t.tx) * (xy.x - t.tx) + (xy.y - t.ty) * (xy.y - t.ty) <= 25000.0 * 25000.0"""

ORACLE["knn_neighbours"] = with_(*GEO) + """SELECT YEAR, code, PRACTICE_CODE, round(sqrt(d2), 6) AS distance,
  CAST(rk AS BIGINT) AS rank FROM ranked WHERE rk <= 5"""
ORACLE["idw_weights"] = with_(*GEO) + """, kw AS (SELECT * FROM ranked WHERE rk <= 5),
w AS (SELECT *, bool_or(d2 = 0) OVER (PARTITION BY YEAR, code) AS hit,
             SUM(CASE WHEN d2 > 0 THEN 1.0 / sqrt(d2) END) OVER (PARTITION BY YEAR, code) AS den FROM kw)
SELECT YEAR, code, PRACTICE_CODE, round(CASE WHEN hit THEN NULL ELSE (1.0 / sqrt(d2)) / den END, 6) AS weight FROM w"""


def _idw_query(kept: str) -> str:
    return with_(*GEO) + f"""SELECT spine.YEAR, spine.code, round(i.loneliness, 6) AS loneliness FROM spine
  LEFT JOIN ({idw_of(kept)}) i USING (YEAR, code)"""


ORACLE["idw_all"] = _idw_query("ranked")
ORACLE["idw_knn"] = _idw_query("(SELECT * FROM ranked WHERE rk <= 5)")
ORACLE["idw_distance_limit"] = _idw_query("(SELECT * FROM ranked WHERE d2 <= 30000.0 * 30000.0)")
ORACLE["area_neighbours"] = with_(AREAS, NEIGH) + "SELECT code, nb FROM neigh"
ORACLE["lisa_scores"] = with_(*GEO, INTERP, NEIGH, LISA) + \
    f"SELECT YEAR, code, {r6('LISA_score', 'LISA_score')}, LISA_support FROM result"
ORACLE["area_interpolated"] = with_(*GEO, INTERP, NEIGH, LISA) + \
    f"SELECT YEAR, code, {r6('loneliness', 'loneliness')}, {r6('LISA_score', 'LISA_score')}, LISA_support FROM result"
_XY_GEO = f"""placed AS (SELECT DISTINCT p.PRACTICE_CODE, n.lat, n.long FROM pidx p JOIN nspl_e n USING (POSTCODE)
  WHERE isfinite(n.lat) AND isfinite(n.long)),
xy AS (SELECT PRACTICE_CODE, bng_x AS x, bng_y AS y FROM ({bng_sql("placed")}))"""
ORACLE["area_interpolated_geo"] = with_(*index_ctes(), NSPL, NSPL_E, _XY_GEO, AREAS, YEARS, SPINE, SOURCES, PAIRS,
                                        INTERP, NEIGH, LISA) + \
    f"SELECT YEAR, code, {r6('loneliness', 'loneliness')}, {r6('LISA_score', 'LISA_score')}, LISA_support FROM result"
ORACLE["parent_area_subset"] = with_(*GEO, INTERP, NEIGH, LISA) + \
    f"""SELECT YEAR, code, {r6('loneliness', 'loneliness')}, {r6('LISA_score', 'LISA_score')}, LISA_support
  FROM result WHERE code IN (SELECT a.code FROM areas a JOIN region r ON a.n_regionkey = r.r_regionkey
                             WHERE r.r_name = 'EUROPE')"""
ORACLE["k_sweep"] = with_(*GEO) + f""", ks AS (SELECT r.*, k FROM ranked r, (VALUES (3), (5), (10)) t(k) WHERE rk <= k)
SELECT YEAR, code, k, round(CASE WHEN bool_or(d2 = 0) THEN NULL
                        ELSE SUM(v / sqrt(d2)) / SUM(1.0 / sqrt(d2)) END, 6) AS loneliness
FROM ks GROUP BY YEAR, code, k"""

# ---- QA ------------------------------------------------------------------------------------

_HSTAT = """hs AS (
  SELECT YEAR, min(loneliness_prac) AS mn, max(loneliness_prac) AS mx, COUNT(loneliness_prac) AS n,
         avg(loneliness_prac) AS mu, stddev_pop(loneliness_prac) AS sigma FROM pidx
  WHERE loneliness_prac IS NOT NULL AND NOT isnan(loneliness_prac) GROUP BY YEAR),
hr AS (SELECT *, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
                 CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM hs)"""
ORACLE["index_histogram"] = with_(*index_ctes(), _HSTAT) + """, b AS (
  SELECT p.YEAR, CAST(least(floor((p.loneliness_prac - hr.lo) * 50 / (hr.hi - hr.lo)), 49) AS INTEGER) AS bin,
         COUNT(*) AS cnt
  FROM pidx p JOIN hr USING (YEAR) GROUP BY 1, 2),
sp AS (SELECT hr.*, CAST(g.bin AS INTEGER) AS bin FROM hr, range(0, 50) g(bin))
SELECT sp.YEAR, sp.bin, round(lo + sp.bin * ((hi - lo) / 50), 6) AS bin_lo,
  round(lo + (sp.bin + 1) * ((hi - lo) / 50), 6) AS bin_hi, CAST(COALESCE(b.cnt, 0) AS BIGINT) AS count,
  round(COALESCE(b.cnt, 0) / (n * ((hi - lo) / 50)), 6) AS density
FROM sp LEFT JOIN b USING (YEAR, bin)"""
ORACLE["index_normal_curve"] = with_(*index_ctes(), _HSTAT) + """, sp AS (
  SELECT hr.*, CAST(g.k AS INTEGER) AS k FROM hr, range(0, 51) g(k))
SELECT YEAR, k, round(lo + k * ((hi - lo) / 50), 6) AS edge,
  round(CASE WHEN sigma > 0 THEN (1.0 / (sqrt(2 * pi()) * sigma))
        * exp(-0.5 * ((lo + k * ((hi - lo) / 50) - mu) / sigma) * ((lo + k * ((hi - lo) / 50) - mu) / sigma)) END, 6)
  AS density FROM sp"""

# ---- manifests -------------------------------------------------------------------------------

CAT = """cm AS (SELECT DISTINCT YEAR_MONTH, CAST(substr(YEAR_MONTH, 1, 4) AS INTEGER) AS y,
                CAST(substr(YEAR_MONTH, 5, 2) AS INTEGER) AS m FROM epd),
cat AS (SELECT lower('EPD_' || YEAR_MONTH) AS bq_table_name, 'EPD_' || YEAR_MONTH AS name,
               'https://example.invalid/EPD_' || YEAR_MONTH || '.csv' AS url,
               'https://example.invalid/EPD_' || YEAR_MONTH || '.zip' AS zip_url, y, m FROM cm),
wanted AS (SELECT y AS year, CAST(g.m AS INTEGER) AS month, printf('EPD_%04d%02d', y, g.m) AS name
           FROM (SELECT DISTINCT y FROM cm) yy, range(1, 13) g(m)),
dl AS (SELECT name, CASE WHEN m % 3 = 2 THEN url || '?old' ELSE url END AS url,
              CASE WHEN m % 3 = 2 THEN zip_url || '?old' ELSE zip_url END AS zip_url,
              m <> 10 AS has_date, m = 7 AS flag FROM cat WHERE m % 3 <> 0),
grp AS (SELECT name, y, m FROM cat WHERE m % 2 = 0)"""
ORACLE["month_spine"] = with_(EPD, CAT) + "SELECT year, month, name FROM wanted"
ORACLE["dataset_name_parts"] = with_(EPD, CAT) + """SELECT name, right(name, 6) AS suffix,
  substr(right(name, 6), 1, 4) AS year_text, CAST(substr(right(name, 6), 1, 4) AS INTEGER) AS year,
  substr(right(name, 6), 5, 2) AS month_text, CAST(substr(right(name, 6), 5, 2) AS INTEGER) AS month,
  make_date(y, m, 1) AS first_day FROM cat"""
ORACLE["dataset_name_quality"] = """WITH d AS (SELECT DISTINCT year(l_shipdate) AS y, month(l_shipdate) AS m FROM lineitem),
n AS (SELECT DISTINCT name FROM (
  SELECT printf('EPD_%04d%02d', y + 20, m) AS name FROM d UNION ALL
  SELECT printf('EPD_%04d%02d', y, m) FROM d UNION ALL
  SELECT printf('EPD_%04d%02d', y + 20, m + 12) FROM d UNION ALL
  SELECT printf('XPD_%04d%02d', y + 20, m) FROM d UNION ALL
  SELECT printf('EPD_%04d', y + 20) FROM d)),
r AS (SELECT name, CASE WHEN length(name) <> 10 THEN 'length'
                        WHEN substr(name, 1, 4) <> 'EPD_' THEN 'prefix'
                        WHEN TRY_CAST(substr(right(name, 6), 1, 4) AS INTEGER) IS NULL
                             OR TRY_CAST(substr(right(name, 6), 1, 4) AS INTEGER) < 2014 THEN 'year'
                        WHEN TRY_CAST(substr(right(name, 6), 5, 2) AS INTEGER) IS NULL
                             OR TRY_CAST(substr(right(name, 6), 5, 2) AS INTEGER) NOT BETWEEN 1 AND 12 THEN 'month'
                   END AS reason FROM n)
SELECT name, reason IS NULL AS valid, reason FROM r"""
ORACLE["catalog_resources"] = with_(EPD, CAT) + "SELECT bq_table_name, name, url, zip_url FROM cat"
ORACLE["manifest_reconcile"] = with_(EPD, CAT) + """, j AS (
  SELECT w.name, c.url AS c_url, c.zip_url AS c_zip, d.url AS m_url, d.zip_url AS m_zip, d.has_date, d.flag,
         a.name IS NOT NULL AS archive
  FROM (SELECT DISTINCT name FROM wanted) w LEFT JOIN cat c USING (name) LEFT JOIN dl d USING (name)
  LEFT JOIN (SELECT name FROM cat WHERE m <> 4) a USING (name)),
k AS (SELECT *, c_url IS NOT NULL AS found,
             c_url IS NOT NULL AND m_url IS NULL AS is_new,
             c_url IS NOT NULL AND m_url IS NOT NULL AND m_url <> c_url AS changed FROM j),
k2 AS (SELECT *, CASE WHEN is_new OR changed THEN true ELSE COALESCE(flag, true) END AS flag0,
              COALESCE(has_date, false) AND NOT is_new AS hd FROM k)
SELECT name, found, CASE WHEN found THEN (CASE WHEN is_new OR changed THEN c_url ELSE m_url END) END AS url,
  CASE WHEN found THEN (CASE WHEN is_new OR changed THEN c_zip ELSE m_zip END) END AS zip_url,
  CASE WHEN found THEN NOT (hd AND NOT flag0 AND archive) END AS update_required,
  CASE WHEN NOT found THEN 'not_found' WHEN is_new THEN 'new' WHEN changed THEN 'url_changed'
       WHEN NOT hd THEN 'no_download_date' WHEN flag0 THEN 'flagged' WHEN NOT archive THEN 'no_archive' END AS reason
FROM k2"""
ORACLE["manifest_ready"] = with_(EPD, CAT) + """, ok AS (SELECT name FROM dl JOIN cat USING (name) WHERE has_date AND NOT flag AND m <> 4)
SELECT g.name, ok.name IS NOT NULL AS download_valid,
  CASE WHEN ok.name IS NOT NULL THEN 'ready' ELSE 'missing_download' END AS status
FROM grp g LEFT JOIN ok USING (name)"""
ORACLE["manifest_pending"] = with_(EPD, CAT) + "SELECT name FROM cat WHERE name NOT IN (SELECT name FROM grp WHERE m <> 8)"
ORACLE["manifest_latest"] = with_(EPD, CAT) + """SELECT name, CASE WHEN m % 3 = 2 THEN url || '?v2' ELSE url END AS url,
  CASE WHEN m % 3 = 2 THEN 2 ELSE 1 END AS event_no FROM cat"""
ORACLE["lookup_staleness"] = with_(EPD, CAT) + """SELECT name, make_date(y, m, 1) AS as_of,
  make_date(y, m, 1) + INTERVAL 6 MONTH < DATE '2041-06-15' AS stale FROM cat"""

from rxatlas.plans import oracle_storage  # noqa: E402,F401  (adds its texts here)
