"""Domain views over the driver's TPC-H-style tables (FIXTURES.md part B).

One lineitem row plays one prescription row, a supplier plays a practice, a
nation plays an area. Every view is a lazy DataFrame over the parquet scans,
so column pruning and filters reach the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxatlas.schemas import EPD_COLUMNS

AREA_SIDE = 20000.0
GRID_COLS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _practice_code(sk):
    """'Y' + key padded to five digits (longer keys kept whole, never cut)."""
    s = sk.cast("string")
    return F.concat(F.lit("Y"), F.when(sk < 100000, F.lpad(s, 5, "0")).otherwise(s))


def _epd_columns(spark: SparkSession, sf_dir: str):
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity",
                                                        "l_extendedprice", "l_shipdate")
    # what a part alone gives is made before the join: once a part, not once a prescription
    part = table(spark, sf_dir, "part").select(
        "p_partkey", F.initcap("p_name").alias("p_title"), "p_size",
        F.concat_ws(" ", "p_name", "p_type", F.concat(F.col("p_size").cast("string"), F.lit("mg"))).alias("p_text"))
    j = li.join(part, li.l_partkey == part.p_partkey)
    sk = F.col("l_suppkey")
    ym = (F.year("l_shipdate") + 20) * 100 + F.month("l_shipdate")
    return j, [
        _practice_code(sk).alias("PRACTICE_CODE"),
        F.concat(F.lit("ab"), F.floor(sk / 10).cast("string"), F.lit(" "),
                 (sk % 10).cast("string"), F.lit("cd")).alias("POSTCODE"),
        ym.cast("string").alias("YEAR_MONTH"),
        F.col("p_title").alias("CHEMICAL_SUBSTANCE_BNF_DESCR"),
        F.col("p_text").alias("BNF_DESCRIPTION"),
        F.col("l_quantity").cast("bigint").alias("ITEMS"),
        (F.col("l_quantity") * F.col("p_size")).alias("TOTAL_QUANTITY"),
        F.col("l_extendedprice").alias("ACTUAL_COST"),
    ]


def epd_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 as it would come off a CSV: every column a string."""
    j, cols = _epd_columns(spark, sf_dir)
    typed = j.select(*cols)
    return typed.select(*[F.col(c).cast("string").alias(c) for c in EPD_COLUMNS])


def epd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 typed (the three measure columns numeric), built directly."""
    j, cols = _epd_columns(spark, sf_dir)
    return j.select(*cols)


def _mapped_suppliers(spark, sf_dir) -> DataFrame:
    # a tenth of the practices find no postcode
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey") \
        .filter(F.col("s_suppkey") % 10 != 9)


def _lad(nk):
    return F.concat(F.when(nk % 5 == 4, F.lit("W")).otherwise(F.lit("E")),
                    F.format_string("%08d", nk))


def nspl_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new postcode lookup with its source column names."""
    s = _mapped_suppliers(spark, sf_dir)
    sk, nk = F.col("s_suppkey"), F.col("s_nationkey")
    lad = _lad(nk)
    msoa = F.concat(lad, F.lit("-"), (sk % 3).cast("string"))
    return s.select(
        F.concat(F.lit("AB"), F.floor(sk / 10).cast("string"), F.lit(" "),
                 (sk % 10).cast("string"), F.lit("CD")).alias("pcds"),
        (50 + ((sk * 37) % 101) / 20.0).alias("lat"),
        (-5 + ((sk * 53) % 97) / 20.0).alias("long"),
        F.concat(msoa, F.lit("-"), (sk % 2).cast("string")).alias("lsoa21cd"),
        msoa.alias("msoa21cd"),
        F.concat(F.lit("C"), (nk % 5).cast("string")).alias("cty25cd"),
        lad.alias("lad25cd"),
        F.concat(F.lit("W"), (sk % 7).cast("string")).alias("wd25cd"),
    )


def nspl_legacy_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The legacy lookup (pcd, lat, long, msoa11, laua)."""
    n = nspl_raw(spark, sf_dir)
    return n.select(F.col("pcds").alias("pcd"), "lat", "long",
                    F.col("msoa21cd").alias("msoa11"), F.col("lad25cd").alias("laua"))


def ods_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organisation lookup with its source column names."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    sk = F.col("s_suppkey")
    return j.select(
        _practice_code(sk).alias("Code"),
        F.when(sk % 10 != 9, F.concat(F.lit("PCN "), (sk % 8).cast("string")))
        .alias("Is Partner To - Name"),
        F.col("n_name").alias("Geographic Primary Care Organisation Name"),
        F.concat(F.lit("ICB "), (F.col("n_nationkey") % 10).cast("string"))
        .alias("High Level Health Geography Name"),
        F.col("r_name").alias("National Grouping Name"),
    )


def practice_xy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T15 planar practice points in metres (same practices as the lookup)."""
    sk = F.col("s_suppkey")
    return _mapped_suppliers(spark, sf_dir).select(
        _practice_code(sk).alias("PRACTICE_CODE"),
        (1000.0 * ((sk * 37) % 101)).alias("x"),
        (1000.0 * ((sk * 53) % 97)).alias("y"),
    )


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One square polygon per nation on a 5-wide grid, 20 km side."""
    nk = F.col("n_nationkey")
    x0 = (nk % GRID_COLS) * AREA_SIDE
    y0 = F.floor(nk / GRID_COLS) * AREA_SIDE
    x1, y1 = x0 + AREA_SIDE, y0 + AREA_SIDE

    def v(x, y):
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    ring = F.array(v(x0, y0), v(x1, y0), v(x1, y1), v(x0, y1), v(x0, y0))
    return table(spark, sf_dir, "nation").select(
        _lad(nk).alias("code"), F.array(F.array(ring)).alias("parts"))


def area_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent of each area (the nation's region), for parent-area subsets."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        _lad(F.col("n_nationkey")).alias("code"), F.col("r_name").alias("parent"))


# Drug/illness dimension for the fixture: fixed values (FIXTURES part B).
# Medicine names are "Adjective Noun"; an illness owns every name whose noun it lists.
FIXTURE_ILLNESSES = [
    ("Depression", ["Loneliness"], ["Ring", "Widget"]),
    ("Alzheimers", ["Loneliness"], ["Bolt"]),
    ("Blood Pressure", ["Loneliness"], ["Rod"]),
    ("Insomnia", ["Loneliness"], ["Plate"]),
    ("Social Anxiety", ["Loneliness"], ["Ring"]),
    ("Diabetes", [], ["Anvil"]),
    ("Addiction", [], ["Gear"]),
]
FIXTURE_MIN_ITEMS = 100


def fixture_spec():
    """Driver-side illness spec used for regex matching (nouns as patterns)."""
    from rxatlas.operators.illness import IllnessSpec
    return [IllnessSpec(i, tuple(t), tuple(n)) for i, t, n in FIXTURE_ILLNESSES]


def illness_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T9 nested dimension: fixture illnesses x the medicine names present in `part`."""
    spec = spark.createDataFrame(
        [(i, t, n) for i, ts, ns in FIXTURE_ILLNESSES for n in ns for t in [ts]],
        "illness string, tags array<string>, noun string")
    names = table(spark, sf_dir, "part").select(F.initcap("p_name").alias("name")).distinct()
    names = names.withColumn("noun", F.element_at(F.split("name", " "), 2))
    j = names.join(F.broadcast(spec), "noun")  # spec is a fixed 8-row list
    return (j.groupBy("illness").agg(
        F.first("tags").alias("tags"),
        F.array_sort(F.collect_set(F.struct("name"))).alias("medications")))


def catalogue_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct YEAR_MONTH values of the prescribing view, with y and m ints."""
    from rxatlas.functions.text import month_part, year_part
    e = epd_raw(spark, sf_dir).select("YEAR_MONTH").distinct()
    return e.select("YEAR_MONTH", year_part("YEAR_MONTH").cast("int").alias("y"),
                    month_part("YEAR_MONTH").cast("int").alias("m"))


def catalogue_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat catalogue resources (the parsed form of T13)."""
    c = catalogue_months(spark, sf_dir)
    name = F.concat(F.lit("EPD_"), F.col("YEAR_MONTH"))
    return c.select(
        F.lower(name).alias("bq_table_name"), name.alias("name"),
        F.concat(F.lit("https://example.invalid/"), name, F.lit(".csv")).alias("url"),
        F.concat(F.lit("https://example.invalid/"), name, F.lit(".zip")).alias("zip_url"),
        "y", "m")


def catalogue_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T13 as landed JSON text: one catalogue document per year."""
    r = catalogue_resources(spark, sf_dir)
    doc = F.struct(
        F.lit(True).alias("success"),
        F.struct(F.lit("prescribing").alias("author"),
                 F.lit("data@example.invalid").alias("author_email"),
                 F.count("*").alias("num_resources"),
                 F.array_sort(F.collect_list(F.struct("bq_table_name", "name", "url", "zip_url")))
                 .alias("resources")).alias("result"))
    return r.groupBy("y").agg(F.to_json(doc).alias("json"))


def download_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months with m % 3 = 0 absent; m % 3 = 2 hold another url;
    update_required for month 7; no download date for month 10."""
    r = catalogue_resources(spark, sf_dir).filter(F.col("m") % 3 != 0)
    other = F.col("m") % 3 == 2
    return r.select(
        "name", F.lit("raw_epds").alias("record_type"),
        F.when(other, F.concat(F.col("url"), F.lit("?old"))).otherwise(F.col("url")).alias("url"),
        F.when(other, F.concat(F.col("zip_url"), F.lit("?old"))).otherwise(F.col("zip_url")).alias("zip_url"),
        F.when(F.col("m") != 10, F.make_timestamp(F.col("y"), F.col("m"), F.lit(28), F.lit(0), F.lit(0), F.lit(0)))
        .alias("latest_download_date"),
        (F.col("m") == 7).alias("update_required"))


def group_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouping done for even months."""
    r = catalogue_resources(spark, sf_dir).filter(F.col("m") % 2 == 0)
    return r.select(
        "name", F.lit("grouped_epds").alias("record_type"),
        F.struct(F.lit("items_by_prescription").alias("name"),
                 F.lit("CHEMICAL_SUBSTANCE_BNF_DESCR").alias("medication_to_use"),
                 F.lit("ITEMS").alias("aggregation_type")).alias("group_method"),
        F.make_timestamp(F.col("y"), F.col("m"), F.lit(28), F.lit(12), F.lit(0), F.lit(0))
        .alias("latest_process_date"),
        F.lit(False).alias("update_required"))


# ---- landed files --------------------------------------------------------------
# The same views written the way deliveries arrive, for the readers to read.

#: Header layouts of landed months by month % 3: columns in another order, a
#: further column, one layout compressed.
FURTHER_COLUMN = "REGIONAL_OFFICE_NAME"


def month_layout(k: int) -> tuple[list[str], str]:
    """Column order and compression of the months with month % 3 = k."""
    if k == 0:
        return list(EPD_COLUMNS), "none"
    if k == 1:
        return [*reversed(EPD_COLUMNS), FURTHER_COLUMN], "none"
    return [*EPD_COLUMNS[3:], *EPD_COLUMNS[:3]], "gzip"


def land_epd(spark: SparkSession, sf_dir: str, path: str, condition: str = "true", raw: DataFrame | None = None) -> str:
    """One CSV a month (``EPD_YYYYMM.csv``, ``.csv.gz``) with its own header
    below ``path``, of the months that ``condition`` (over y, m) holds for."""
    from rxatlas.sources.storage import rename_parts
    raw = epd_raw(spark, sf_dir) if raw is None else raw
    raw = raw.select("*", F.lit("LONDON").alias(FURTHER_COLUMN), F.col("YEAR_MONTH").alias("ym"),
                     F.substring("YEAR_MONTH", 1, 4).cast("int").alias("y"), F.substring("YEAR_MONTH", 5, 2).cast("int").alias("m"))
    for k in range(3):
        order, codec = month_layout(k)
        stage = f"{path}/_stage{k}"
        (raw.where(condition).where(F.col("m") % 3 == k).select(*order, "ym").repartition("ym")
         .write.partitionBy("ym").option("header", True).option("compression", codec).csv(stage))
        end = ".csv.gz" if codec == "gzip" else ".csv"
        rename_parts(spark, stage, path, lambda ym, n, end=end: f"EPD_{ym}{f'_{n}' if n else ''}{end}")
    return path


def land_archives(spark: SparkSession, names: DataFrame, path: str) -> str:
    """A small ``<name>.zip`` below ``path`` for each of ``names`` (name)."""
    from rxatlas.sources.storage import rename_parts
    (names.select(F.col("name").alias("value"), "name").repartition(1).write.partitionBy("name").text(f"{path}/_stage"))
    rename_parts(spark, f"{path}/_stage", path, lambda name, n: f"{name}.zip")
    return path


def land_csv(df: DataFrame, path: str, key: str) -> str:
    """A lookup as one header CSV, sorted by its key."""
    df.orderBy(key).coalesce(1).write.option("header", True).csv(path)
    return path


def irregular_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas that are no squares: a six-sided ring per nation, every third one
    with a hole, every fourth one with a second part."""
    nk = F.col("n_nationkey")
    x0 = (nk % GRID_COLS) * AREA_SIDE + 100.0 * nk
    y0 = F.floor(nk / GRID_COLS) * AREA_SIDE + 250.0 * (nk % 3)

    def ring(*points):
        return F.array(*[F.array((x0 + float(x)).cast("double"), (y0 + float(y)).cast("double")) for x, y in points])

    outer = ring((0, 0), (9000, -500), (18000, 2000), (16500, 11000), (8000, 15000), (500, 9000), (0, 0))
    hole = ring((5000, 4000), (9000, 4500), (7000, 8000), (5000, 4000))
    second = ring((18500, 14000), (19500, 14500), (19000, 16000), (18500, 14000))
    part = F.when(nk % 3 == 0, F.array(outer, hole)).otherwise(F.array(outer))
    return table(spark, sf_dir, "nation").select(
        "n_nationkey", _lad(nk).alias("code"),
        F.when(nk % 4 == 0, F.array(part, F.array(second))).otherwise(F.array(part)).alias("parts"))


def land_geojson(areas: DataFrame, path: str, code_property: str) -> str:
    """``areas`` (n_nationkey, code, parts as nested arrays) as one feature collection in one file."""
    single = F.size("parts") == 1
    kind = F.when(single, F.lit("Polygon")).otherwise(F.lit("MultiPolygon"))
    coordinates = F.when(single, F.to_json(F.col("parts")[0])).otherwise(F.to_json("parts"))
    feature = F.concat(F.lit('{"type": "Feature", "properties": {"'), F.lit(code_property), F.lit('": "'), "code",
                       F.lit('", "note": "a {brace} and a \\"quote\\""}, "geometry": {"type": "'), kind, F.lit('", "coordinates": '),
                       coordinates, F.lit("}}"))
    body = areas.agg(F.array_sort(F.collect_list(F.struct("n_nationkey", feature.alias("f")))).alias("l"))
    text = F.concat(F.lit('{"type": "FeatureCollection", "name": "areas", "features": [\n'), F.array_join(F.col("l.f"), ",\n"), F.lit("\n]}"))
    body.select(text.alias("value")).coalesce(1).write.text(path)
    return path


#: Vintages of the fixture's geographies and the years they stand for: fixed values.
AREA_VINTAGES = [("lsoa", "2011", 2011, 2015), ("lsoa", "2021", 2016, None), ("msoa", "2011", 2011, 2014), ("msoa", "2021", 2015, None),
                 ("lad", "2013", None, 2013), ("lad", "2015", 2015, 2016), ("ward", "2016", 2016, 2016)]
LATE_VINTAGE = "2021"


def mixed_areas(spark: SparkSession, sf_dir: str, changed: bool = False) -> DataFrame:
    """T14 squares of sides from 50 m to 51 km (a supplier each) and 1000 km (a
    region each). ``changed``: suppliers 1 and 2 moved, 3 gone, one more."""
    def square(df, code, x0, y0, side):
        df = df.select(code.alias("code"), x0.cast("double").alias("x0"), y0.cast("double").alias("y0"), side.cast("double").alias("s"))
        v = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
        x0, y0, x1, y1 = F.col("x0"), F.col("y0"), F.col("x0") + F.col("s"), F.col("y0") + F.col("s")
        return df.select("code", F.array(F.array(F.array(v(x0, y0), v(x1, y0), v(x1, y1), v(x0, y1), v(x0, y0)))).alias("parts"))

    sk, rk = F.col("s_suppkey"), F.col("r_regionkey")
    s, r = table(spark, sf_dir, "supplier").select("s_suppkey"), table(spark, sf_dir, "region").select("r_regionkey")
    x, y = 1000.0 * ((sk * 37) % 101), 1000.0 * ((sk * 53) % 97)
    if changed:
        s = s.where(sk != 3).union(spark.createDataFrame([(1000003,)], "k bigint"))
        x, y = F.when(sk.isin(1, 2), x + 3000.0).otherwise(x), F.when(sk.isin(1, 2), y + 7000.0).otherwise(y)
    return square(s, F.concat(F.lit("A"), sk.cast("string")), x, y, 50.0 * F.pow(F.lit(2.0), sk % 11)).union(
        square(r, F.concat(F.lit("R"), rk.cast("string")), -100000.0 + 10000.0 * rk, -100000.0 - 10000.0 * rk, F.lit(1000000.0)))
