"""S10 + F4: area boundaries landed as GeoJSON in EPSG:27700.

A feature collection is one JSON document, often one very large file. It is read
in splits: the text source cuts the file at ``"Feature"``, the value that every
feature's type member has, so a record is one feature without the member's
begin, and a large file is many tasks. The record's JSON parser stops at the
feature's end. Writers put the type first in a feature; where they don't, or a
property has that very value, records don't parse as features, the check below
sees it, and the document is read whole.

Polygon and MultiPolygon features are read in one pass: the geometry's
coordinates arrive as raw JSON text and are parsed by geometry type into
the common ``parts -> rings -> vertices`` shape (T14).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxatlas.schemas import AREA

_FEATURE = T.StructType([
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.StringType()),   # raw JSON text, parsed per type below
    ])),
])
_FEATURES = T.StructType([T.StructField("features", T.ArrayType(_FEATURE))])
#: What the text source cuts a collection at.
BOUNDARY = '"Feature"'


def _to_vertices(ring):
    return F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))


def feature_records(spark: SparkSession, path: str) -> DataFrame:
    """(head, value): the text between two feature boundaries; head marks what stands before a file's first one."""
    lines = spark.read.option("lineSep", BOUNDARY).text(path)
    opens = F.col("value").rlike(r'^\s*[\[{]')  # a document's begin: no feature goes on there
    return lines.select(opens.alias("head"), "value")


def split_features(spark: SparkSession, path: str) -> DataFrame | None:
    """The features of the collections at ``path``, a row each; None where they
    can't be told apart by the boundary."""
    r = feature_records(spark, path)
    # behind the boundary: a comma; at a record's end: the next feature's begin, or the collection's end
    ok = F.when(F.col("head"), F.col("value").rlike(r'\{\s*"type"\s*:\s*$')).otherwise(
        F.col("value").rlike(r'^\s*,') & F.col("value").rlike(r'(?:\}\s*,\s*\{\s*"type"\s*:\s*|\}\s*\][^\[\]]*\}\s*)$'))
    check = r.agg(F.count("*").alias("n"), F.count_if(~F.col("head")).alias("features"), F.count_if(~ok).alias("bad")).first()
    if not check.features or check.bad:
        return None
    text = F.concat(F.lit('{"type": ' + BOUNDARY), "value")
    return r.where(~F.col("head")).select(F.from_json(text, _FEATURE).alias("f"))


def read_boundaries_geojson(spark: SparkSession, path: str, code_property: str,
                            england_only: bool = True, split: bool = True) -> DataFrame:
    """(code, parts) per feature; with ``england_only`` keep codes starting 'E'.
    An area whose geometry is null or of another type stays, with null parts.
    Without ``split`` each file is read as one document, in one task."""
    f = split_features(spark, path) if split else None
    if f is None:
        doc = spark.read.schema(_FEATURES).option("multiLine", True).json(path)
        f = doc.select(F.explode("features").alias("f"))
    f = f.select(
        F.col("f.properties")[code_property].alias("code"),
        F.col("f.geometry.type").alias("gtype"), F.col("f.geometry.coordinates").alias("c"))
    poly = F.from_json("c", "array<array<array<double>>>")
    multi = F.from_json("c", "array<array<array<array<double>>>>")
    parts = F.when(F.col("gtype") == "Polygon",
                   F.array(F.transform(poly, _to_vertices))) \
        .when(F.col("gtype") == "MultiPolygon",
              F.transform(multi, lambda part: F.transform(part, _to_vertices)))
    out = f.select("code", parts.alias("parts"))
    if england_only:
        out = out.filter(F.col("code").startswith("E"))
    return out.select(F.col("code"), F.col("parts").cast(AREA["parts"].dataType))
