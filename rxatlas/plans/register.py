"""Query register: every SURVEY §7.4 query as (spark, sf_dir) -> DataFrame.

Each query reads the driver tables through the domain views of
``rxatlas.sources.fixtures`` and runs a library operator over the whole
tables. Computed doubles are rounded to 6 digits at the very end so the
result compares with an independent SQL engine regardless of summation
order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxatlas.functions.geo import to_bng, valid_point
from rxatlas.functions.text import (month_part, month_text, normalise_postcode, strip_blanks,
                                    strip_whitespace, year_part, year_text, dataset_name)
from rxatlas.operators import adjacency as adj
from rxatlas.operators import area as ar
from rxatlas.operators import grouping as grp
from rxatlas.operators import illness as ill
from rxatlas.operators import index as idx
from rxatlas.operators import knn
from rxatlas.operators import manifest as mf
from rxatlas.operators import qa
from rxatlas.plans import jobs
from rxatlas.session import materialize, scratch_path
from rxatlas.sources import fixtures as fx
from rxatlas.sources import lookups as lk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

TAG = "Loneliness"
K = 5
DISTANCE_LIMIT = 30000.0
PAIR_LIMIT = 25000.0
K_SWEEP = (3, 5, 10)
LISA_THRESHOLD = 0.0
RUN_DATE = "2041-06-15"
PARENT = "EUROPE"
SINGLE_ILLNESS = "Depression"
AREA_COL = "laua"
YEAR = 2015


_MEMO: dict = {}


def query(name):
    """Register ``fn``; each run starts with an empty memo, so a query reuses
    its own intermediate results (e.g. the checkpointed practice index) but
    never another query's."""
    def deco(fn):
        def run(spark, sf):
            _MEMO.clear()
            try:
                return fn(spark, sf)
            finally:
                _MEMO.clear()
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def _memo(key, build):
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])


# ---- shared building blocks --------------------------------------------------

def _spec():
    return fx.fixture_spec()


def _index_spec():
    return ill.spec_by_tag(_spec(), TAG)


def _epd(spark, sf):
    return fx.epd(spark, sf)


def _grouped(spark, sf, measure="ITEMS", medication="CHEMICAL_SUBSTANCE_BNF_DESCR"):
    return grp.group_month(_epd(spark, sf), medication, measure)


def _dim(spark, sf):
    return fx.illness_dimension(spark, sf)


def _pindex(spark, sf, index_spec=None):
    spec = index_spec or _index_spec()
    return _memo(("pindex", sf, tuple(s.column for s in spec)), lambda: idx.practice_index(
        _epd(spark, sf), _spec(), spec, min_items=fx.FIXTURE_MIN_ITEMS))


def _nspl_e(spark, sf):
    return lk.nspl_england(fx.nspl_legacy_raw(spark, sf))


def _pindex_geo(spark, sf, index_spec=None):
    return idx.attach_geography(_pindex(spark, sf, index_spec), _nspl_e(spark, sf))


def _areas_e(spark, sf):
    return fx.areas(spark, sf).filter(F.col("code").startswith("E"))


def _targets(spark, sf):
    c = adj.centroids(_areas_e(spark, sf))
    return c.select("code", F.col("cx").alias("tx"), F.col("cy").alias("ty"))


def _sources(spark, sf, index_spec=None):
    """Practice-year index values at the practices' planar points."""
    pts = fx.practice_xy(spark, sf).filter(valid_point("x", "y"))
    return _pindex(spark, sf, index_spec).select("YEAR", "PRACTICE_CODE", idx.INDEX_COLUMN) \
        .join(pts, "PRACTICE_CODE")


def _years(spark, sf):
    return ar.years_of(_pindex(spark, sf))


def _interpolated(spark, sf, k=K, index_spec=None):
    vals = knn.interpolate(_targets(spark, sf), _sources(spark, sf, index_spec), ["YEAR"],
                           idx.INDEX_COLUMN, k=k)
    spine = ar.area_year_spine(_areas_e(spark, sf), _years(spark, sf))
    return spine.join(vals.withColumnRenamed("value", "loneliness"), ["YEAR", "code"], "left")


def _pairs(spark, sf):
    return adj.neighbour_pairs(_areas_e(spark, sf))


def _area_result(spark, sf, k=K, index_spec=None):
    v = materialize(_interpolated(spark, sf, k, index_spec))  # read three times below
    lisa = adj.lisa(v, _pairs(spark, sf), ["YEAR"], "loneliness", LISA_THRESHOLD)
    return v.join(lisa, ["YEAR", "code"], "left")


def _score_cols(index_spec=None):
    return [idx.zscore(s.column) for s in (index_spec or _index_spec())]


def _area_mean(spark, sf):
    return ar.area_mean_index(_pindex_geo(spark, sf), _areas_e(spark, sf), AREA_COL, _score_cols())


# ---- scan / shape ---------------------------------------------------------------

@query("postcode_norm")
def q_postcode_norm(spark, sf):
    p = _epd(spark, sf).select("POSTCODE").distinct()
    return p.select(F.col("POSTCODE").alias("raw_postcode"), strip_whitespace("POSTCODE").alias("no_space"),
                    strip_blanks("POSTCODE").alias("no_blank"),
                    normalise_postcode("POSTCODE").alias("postcode"))


@query("year_month_parts")
def q_year_month_parts(spark, sf):
    ym = _epd(spark, sf).select("YEAR_MONTH").distinct()
    return ym.select("YEAR_MONTH", year_part("YEAR_MONTH").alias("year"),
                     month_part("YEAR_MONTH").alias("month"),
                     year_text("YEAR_MONTH").alias("year_text"), month_text("YEAR_MONTH").alias("month_text"),
                     dataset_name(year_part("YEAR_MONTH"), month_part("YEAR_MONTH")).alias("name"))


@query("england_areas")
def q_england_areas(spark, sf):
    a = _areas_e(spark, sf)
    v = F.flatten(F.flatten("parts"))
    return rounded(a.select(
        "code", F.size("parts").alias("n_parts"), F.size(v).alias("n_vertices"),
        F.array_min(F.transform(v, lambda p: p["x"])).alias("minx"),
        F.array_min(F.transform(v, lambda p: p["y"])).alias("miny"),
        F.array_max(F.transform(v, lambda p: p["x"])).alias("maxx"),
        F.array_max(F.transform(v, lambda p: p["y"])).alias("maxy")))


@query("schema_contract")
def q_schema_contract(spark, sf):
    return lk.schema_contract({"nspl": fx.nspl_raw(spark, sf), "ods": fx.ods_raw(spark, sf)})


# ---- grouping -------------------------------------------------------------------

@query("month_items")
def q_month_items(spark, sf):
    return _grouped(spark, sf)


@query("month_quantity")
def q_month_quantity(spark, sf):
    return rounded(_grouped(spark, sf, "TOTAL_QUANTITY"))


@query("month_cost")
def q_month_cost(spark, sf):
    return rounded(_grouped(spark, sf, "ACTUAL_COST", "BNF_DESCRIPTION"))


@query("grouped_roundtrip")
def q_grouped_roundtrip(spark, sf):
    path = scratch_path(spark, "grouped")
    grp.write_grouped(_grouped(spark, sf), path)
    return grp.read_grouped(spark, path)


@query("month_reprocess")
def q_month_reprocess(spark, sf):
    """Write every month, then rewrite the even months without the Gizmo
    medicines: those vanish from even months only."""
    path = scratch_path(spark, "reprocess")
    g = _grouped(spark, sf)
    grp.write_grouped(g, path)
    redo = g.filter((F.col("month") % 2 == 0) & ~F.col("medication").endswith("Gizmo"))
    grp.write_grouped(redo, path)
    return grp.read_grouped(spark, path)


@query("year_medication_totals")
def q_year_medication_totals(spark, sf):
    return grp.year_medication_totals(_grouped(spark, sf))


@query("analyst_year_totals")
def q_analyst_year_totals(spark, sf):
    """C6 + F5: one year's totals from the written base table."""
    path = scratch_path(spark, "analyst")
    grp.write_grouped(_grouped(spark, sf), path)
    return jobs.analyst_totals(spark, path, YEAR)


# ---- dimension ------------------------------------------------------------------

@query("illness_dim")
def q_illness_dim(spark, sf):
    f = ill.flat_dimension(_dim(spark, sf))
    return f.select("illness", F.array_join(F.array_sort("tags"), ",").alias("tags"), "medication")


@query("dim_tags")
def q_dim_tags(spark, sf):
    return ill.all_tags(_dim(spark, sf))


@query("dim_illnesses")
def q_dim_illnesses(spark, sf):
    return ill.all_illnesses(_dim(spark, sf))


@query("meds_all")
def q_meds_all(spark, sf):
    return ill.medications(_dim(spark, sf))


@query("meds_by_tag")
def q_meds_by_tag(spark, sf):
    return ill.medications(_dim(spark, sf), tag="loneliness")


@query("meds_by_illness")
def q_meds_by_illness(spark, sf):
    return ill.medications(_dim(spark, sf), illness="social anxiety")


@query("illness_by_tag")
def q_illness_by_tag(spark, sf):
    return ill.select_illnesses(_dim(spark, sf), tag=TAG).select("illness")


@query("meds_filter_totals")
def q_meds_filter_totals(spark, sf):
    return ill.medication_totals(_grouped(spark, sf), _dim(spark, sf), tag=TAG)


@query("practice_index_saved")
def q_practice_index_saved(spark, sf):
    """C2 as a job: index with geography written by year (K3), read back
    under the boundary's area key."""
    path = scratch_path(spark, "index")
    jobs.practice_index_job(_epd(spark, sf), _nspl_e(spark, sf), path, _spec(), TAG, fx.FIXTURE_MIN_ITEMS)
    saved = jobs.read_practice_index(spark, path, AREA_COL, "code")
    return rounded(saved.select("PRACTICE_CODE", F.col("YEAR").cast("string").alias("YEAR"), "POSTCODE", "ITEMS",
                                idx.INDEX_COLUMN, "code"))


@query("illness_medication_totals")
def q_illness_medication_totals(spark, sf):
    return ill.illness_medication_totals(_grouped(spark, sf), _dim(spark, sf))


# ---- practice index -------------------------------------------------------------

@query("illness_item_flags")
def q_illness_item_flags(spark, sf):
    return idx.flag_items(_epd(spark, sf), _spec())


@query("illness_totals")
def q_illness_totals(spark, sf):
    return ill.illness_totals(idx.flag_items(_epd(spark, sf), _spec()), _spec())


@query("practice_month_counts")
def q_practice_month_counts(spark, sf):
    return idx.practice_month_counts(idx.flag_items(_epd(spark, sf), _spec()), _spec())


@query("practice_month_kept")
def q_practice_month_kept(spark, sf):
    c = idx.practice_month_counts(idx.flag_items(_epd(spark, sf), _spec()), _spec())
    return idx.practice_month_kept(c, _spec(), fx.FIXTURE_MIN_ITEMS)


def _year_counts(spark, sf):
    return idx.practice_year_table(_epd(spark, sf), _spec(), _index_spec(), fx.FIXTURE_MIN_ITEMS)


@query("practice_year_counts")
def q_practice_year_counts(spark, sf):
    return _year_counts(spark, sf)


@query("illness_percent")
def q_illness_percent(spark, sf):
    return rounded(idx.illness_percent(_year_counts(spark, sf), _index_spec()))


def _percent(spark, sf):
    """The practice-year percentages, stored: several passes read them."""
    return materialize(idx.illness_percent(_year_counts(spark, sf), _index_spec()))


@query("illness_quantiles")
def q_illness_quantiles(spark, sf):
    pct = _percent(spark, sf)
    return rounded(idx.illness_quantiles(pct, _index_spec()))


@query("illness_clip")
def q_illness_clip(spark, sf):
    pct = _percent(spark, sf)
    return rounded(idx.illness_clip(pct, _index_spec()))


@query("illness_zscore")
def q_illness_zscore(spark, sf):
    pct = _percent(spark, sf)
    return rounded(idx.illness_zscore(idx.illness_clip(pct, _index_spec()), _index_spec()))


@query("practice_index")
def q_practice_index(spark, sf):
    return rounded(_pindex(spark, sf))


@query("practice_index_geo")
def q_practice_index_geo(spark, sf):
    return rounded(_pindex_geo(spark, sf))


# ---- areas ------------------------------------------------------------------------

@query("area_mean_index")
def q_area_mean_index(spark, sf):
    return rounded(_area_mean(spark, sf))


@query("area_support")
def q_area_support(spark, sf):
    return _area_mean(spark, sf).select("YEAR", "code", "ITEMS")


@query("area_aggregated")
def q_area_aggregated(spark, sf):
    return rounded(ar.order_areas(_area_mean(spark, sf).select("YEAR", "code", "loneliness", "ITEMS")))


@query("map_to_postcode_area")
def q_map_to_postcode_area(spark, sf):
    mapper = lk.nspl_select(fx.nspl_raw(spark, sf))
    g = _grouped(spark, sf).withColumn("postcode", normalise_postcode("postcode"))
    return ar.map_to_area(g, mapper, "lad", ill.medications(_dim(spark, sf), tag=TAG))


@query("map_to_practice_area")
def q_map_to_practice_area(spark, sf):
    mapper = lk.ods_select(fx.ods_raw(spark, sf))
    return ar.map_to_area(_grouped(spark, sf), mapper, "pcn_name",
                          ill.medications(_dim(spark, sf), tag=TAG))


# ---- geometry -----------------------------------------------------------------------

@query("practice_points")
def q_practice_points(spark, sf):
    codes = _epd(spark, sf).select("PRACTICE_CODE", normalise_postcode("POSTCODE").alias("POSTCODE")) \
        .distinct()
    j = codes.join(lk.dedup_on_key(_nspl_e(spark, sf), "POSTCODE"), "POSTCODE")
    # F6 on the inputs: a projected point is valid exactly when lat/long are
    p = to_bng(j.select("PRACTICE_CODE", "POSTCODE", "lat", "long").filter(valid_point("lat", "long")))
    return rounded(p.select("PRACTICE_CODE", "POSTCODE", "x", "y"), 3)


@query("area_centroids")
def q_area_centroids(spark, sf):
    return rounded(adj.centroids(_areas_e(spark, sf)))


@query("practice_area_distance")
def q_practice_area_distance(spark, sf):
    pts = fx.practice_xy(spark, sf).filter(valid_point())
    folded = pts.withColumn("P", F.lit(1)).groupBy("P", "x", "y").agg(
        F.count("*").alias("n"), F.lit(0.0).alias("sz"))
    near = knn.limit_points(_targets(spark, sf), folded, ["P"], PAIR_LIMIT)
    j = near.join(pts, ["x", "y"])
    return rounded(j.select("code", "PRACTICE_CODE", F.sqrt("d2").alias("distance")))


def _knn_kept(spark, sf, k=K):
    pts = knn.fold_points(_sources(spark, sf), ["YEAR"], idx.INDEX_COLUMN)
    return knn.neighbour_points(_targets(spark, sf), pts, ["YEAR"], k=k)


@query("knn_neighbours")
def q_knn_neighbours(spark, sf):
    kept = _knn_kept(spark, sf)
    j = kept.join(_sources(spark, sf), ["YEAR", "x", "y"])
    return rounded(j.select("YEAR", "code", "PRACTICE_CODE", F.sqrt("d2").alias("distance"),
                            F.col("rank").cast("bigint").alias("rank")))


@query("idw_weights")
def q_idw_weights(spark, sf):
    w = knn.idw_weights(_knn_kept(spark, sf), ["YEAR", "code"])
    j = w.join(_sources(spark, sf), ["YEAR", "x", "y"])
    return rounded(j.select("YEAR", "code", "PRACTICE_CODE", "weight"))


def _idw(spark, sf, **kw):
    v = knn.interpolate(_targets(spark, sf), _sources(spark, sf), ["YEAR"], idx.INDEX_COLUMN, **kw)
    spine = ar.area_year_spine(_areas_e(spark, sf), _years(spark, sf))
    return rounded(spine.join(v.withColumnRenamed("value", "loneliness"), ["YEAR", "code"], "left"))


@query("idw_all")
def q_idw_all(spark, sf):
    return _idw(spark, sf)


@query("idw_knn")
def q_idw_knn(spark, sf):
    return _idw(spark, sf, k=K)


@query("idw_distance_limit")
def q_idw_distance_limit(spark, sf):
    return _idw(spark, sf, distance_limit=DISTANCE_LIMIT)


@query("area_neighbours")
def q_area_neighbours(spark, sf):
    return _pairs(spark, sf)


@query("lisa_scores")
def q_lisa_scores(spark, sf):
    r = _area_result(spark, sf)
    return rounded(r.select("YEAR", "code", "LISA_score", "LISA_support"))


@query("area_interpolated")
def q_area_interpolated(spark, sf):
    r = _area_result(spark, sf)
    return rounded(ar.order_areas(r.select("YEAR", "code", "loneliness", "LISA_score", "LISA_support")))


@query("area_interpolated_geo")
def q_area_interpolated_geo(spark, sf):
    """C3 end to end: index with geography -> grid metres -> IDW -> LISA, written (K4) and read back."""
    path = scratch_path(spark, "interpolated")
    jobs.interpolate_geo_job(_pindex_geo(spark, sf), _areas_e(spark, sf), K, threshold=LISA_THRESHOLD, out_path=path)
    return rounded(spark.read.parquet(path))


# ---- QA -------------------------------------------------------------------------------

@query("index_histogram")
def q_index_histogram(spark, sf):
    return rounded(qa.histogram(_pindex(spark, sf), ["YEAR"], idx.INDEX_COLUMN))


@query("index_normal_curve")
def q_index_normal_curve(spark, sf):
    return rounded(qa.normal_curve(_pindex(spark, sf), ["YEAR"], idx.INDEX_COLUMN))


@query("quantile_classes")
def q_quantile_classes(spark, sf):
    v = _area_mean(spark, sf).select("YEAR", "code", "loneliness")
    return rounded(qa.quantile_classes(v, ["YEAR"], "code", "loneliness"))


# ---- manifests ----------------------------------------------------------------------

def _wanted(spark, sf):
    return mf.month_spine(fx.catalogue_months(spark, sf).select(F.col("y").alias("year")))


@query("month_spine")
def q_month_spine(spark, sf):
    return _wanted(spark, sf)


@query("dataset_name_parts")
def q_dataset_name_parts(spark, sf):
    return mf.name_parts(fx.catalogue_resources(spark, sf).select("name"))


@query("dataset_name_quality")
def q_dataset_name_quality(spark, sf):
    """Names as landed plus names built from the unshifted ship date and a
    month counter past 12: both kinds must be rejected."""
    li = fx.table(spark, sf, "lineitem").select("l_shipdate").distinct()
    y, m = F.year("l_shipdate"), F.month("l_shipdate")
    names = li.select(F.explode(F.array(
        F.format_string("EPD_%04d%02d", y + 20, m),
        F.format_string("EPD_%04d%02d", y, m),
        F.format_string("EPD_%04d%02d", y + 20, m + 12),
        F.format_string("XPD_%04d%02d", y + 20, m),
        F.format_string("EPD_%04d", y + 20))).alias("name")).distinct()
    return mf.name_quality(names)


@query("catalog_resources")
def q_catalog_resources(spark, sf):
    return mf.parse_catalogue(fx.catalogue_documents(spark, sf))


@query("manifest_latest")
def q_manifest_latest(spark, sf):
    """Event log: one download event per month, a second one (new url) for
    months with m % 3 = 2; the latest event per name is the state."""
    r = fx.catalogue_resources(spark, sf)
    first = r.select("name", F.col("url"), F.lit(1).alias("event_no"))
    second = r.filter(F.col("m") % 3 == 2).select(
        "name", F.concat(F.col("url"), F.lit("?v2")).alias("url"), F.lit(2).alias("event_no"))
    log = first.unionByName(second).withColumnRenamed("event_no", "event_time")
    return mf.latest_state(log, tie_break="url").select("name", "url", F.col("event_time").alias("event_no"))


@query("lookup_staleness")
def q_lookup_staleness(spark, sf):
    c = fx.catalogue_months(spark, sf)
    lk_df = c.select(F.concat(F.lit("EPD_"), "YEAR_MONTH").alias("name"),
                     F.upper(F.date_format(F.make_date("y", "m", F.lit(1)), "MMM_yyyy")).alias("as_of_text"))
    return mf.lookup_staleness(lk_df, RUN_DATE).select("name", "as_of", "stale")


# ---- extras ---------------------------------------------------------------------------

@query("k_sweep")
def q_k_sweep(spark, sf):
    pts = knn.fold_points(_sources(spark, sf), ["YEAR"], idx.INDEX_COLUMN)
    kept = knn.neighbour_points(_targets(spark, sf), pts, ["YEAR"], k=max(K_SWEEP))
    ks = kept.select("*", F.explode(F.array(*[F.lit(k) for k in K_SWEEP])).alias("k")) \
        .filter(F.col("rank") <= F.col("k"))
    return rounded(knn.idw_from_points(ks, ["YEAR", "code", "k"]).withColumnRenamed("value", "loneliness"))


@query("parent_area_subset")
def q_parent_area_subset(spark, sf):
    r = _area_result(spark, sf)
    parents = fx.area_parent(spark, sf).filter(F.col("parent") == PARENT)
    sub = r.join(parents, "code", "left_semi")
    return rounded(sub.select("YEAR", "code", "loneliness", "LISA_score", "LISA_support"))


@query("single_illness_index")
def q_single_illness_index(spark, sf):
    one = ill.spec_by_names(_spec(), [SINGLE_ILLNESS])
    return rounded(_pindex(spark, sf, one).select(
        "PRACTICE_CODE", "YEAR", "POSTCODE", idx.zscore(one[0].column), idx.INDEX_COLUMN))


from rxatlas.plans import register_storage  # noqa: E402,F401  (registers its queries here)
