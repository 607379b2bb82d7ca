"""Table shapes and the area-type vocabulary."""

from pyspark.sql import types as T

S, L, D = T.StringType(), T.LongType(), T.DoubleType()

# One prescribing month. Read as strings, three measure columns typed.
EPD_COLUMNS = ["PRACTICE_CODE", "POSTCODE", "YEAR_MONTH", "CHEMICAL_SUBSTANCE_BNF_DESCR",
               "BNF_DESCRIPTION", "ITEMS", "TOTAL_QUANTITY", "ACTUAL_COST"]
EPD_MEASURE_TYPES = {"ITEMS": "bigint", "TOTAL_QUANTITY": "double", "ACTUAL_COST": "double"}
EPD_MEDICATION_COLUMNS = ("CHEMICAL_SUBSTANCE_BNF_DESCR", "BNF_DESCRIPTION")

# Grouped month; year/month are partition columns and need this schema on
# read, otherwise partition discovery hands them back as int.
GROUPED = T.StructType([
    T.StructField("practice_code", S), T.StructField("postcode", S),
    T.StructField("medication", S), T.StructField("total_items", L),
    T.StructField("year", T.ShortType()), T.StructField("month", T.ByteType()),
])


def grouped_schema(measure_type: str = "bigint") -> T.StructType:
    dt = L if measure_type == "bigint" else D
    return T.StructType([f if f.name != "total_items" else T.StructField("total_items", dt)
                         for f in GROUPED.fields])


# The drug/illness dimension, nested.
ILLNESS_DIM = T.StructType([
    T.StructField("illness", S),
    T.StructField("tags", T.ArrayType(S)),
    T.StructField("medications", T.ArrayType(T.StructType([T.StructField("name", S)]))),
])

# Manifests.
DOWNLOAD_MANIFEST = T.StructType([
    T.StructField("name", S), T.StructField("record_type", S), T.StructField("url", S),
    T.StructField("zip_url", S), T.StructField("latest_download_date", T.TimestampType()),
    T.StructField("update_required", T.BooleanType()),
])
GROUP_METHOD = T.StructType([T.StructField("name", S), T.StructField("medication_to_use", S),
                             T.StructField("aggregation_type", S)])
GROUP_MANIFEST = T.StructType([
    T.StructField("name", S), T.StructField("record_type", S),
    T.StructField("group_method", GROUP_METHOD),
    T.StructField("latest_process_date", T.TimestampType()),
    T.StructField("update_required", T.BooleanType()),
])

# T12 as a log: what a run set out to do with a month, and what it finished.
LEDGER = T.StructType([
    *GROUP_MANIFEST.fields,
    T.StructField("run_id", S), T.StructField("event", S),
    T.StructField("n_files", L), T.StructField("bytes", L),
    T.StructField("n_groups", L), T.StructField("total", D),
])

# Remote catalogue document.
RESOURCE = T.StructType([T.StructField(n, S) for n in ("bq_table_name", "name", "url", "zip_url")])
CATALOGUE = T.StructType([
    T.StructField("success", T.BooleanType()),
    T.StructField("result", T.StructType([
        T.StructField("author", S), T.StructField("author_email", S),
        T.StructField("num_resources", L),
        T.StructField("resources", T.ArrayType(RESOURCE)),
    ])),
])

# Area boundaries, parts -> rings -> vertices, planar metres.
VERTEX = T.StructType([T.StructField("x", D), T.StructField("y", D)])
AREA = T.StructType([T.StructField("code", S),
                     T.StructField("parts", T.ArrayType(T.ArrayType(T.ArrayType(VERTEX))))])

# Area-type vocabulary: fixed values that must equal the reference's.
PRACTICE_KEY = "practice_code"
PRACTICE_AREA_TYPES = ("pcn_name", "sub_icb_name", "icb_name", "nhser_name")
POSTCODE_KEY = "postcode"
POSTCODE_AREA_TYPES = ("lsoa21cd", "msoa21cd", "county", "lad", "ward")
LOCATION_COLUMNS = ("lat", "long")


def area_key(area_type: str) -> str:
    """Which key of the grouped table an area type is reached through."""
    if area_type in PRACTICE_AREA_TYPES:
        return PRACTICE_KEY
    if area_type in POSTCODE_AREA_TYPES:
        return POSTCODE_KEY
    raise ValueError(f"unknown area type {area_type!r}")
