"""Postcode and organisation lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxatlas.functions.text import normalise_postcode
from rxatlas.sources.epd import first_lines
from rxatlas.schemas import (LOCATION_COLUMNS, POSTCODE_AREA_TYPES, POSTCODE_KEY,
                             PRACTICE_AREA_TYPES, PRACTICE_KEY)

# Target name -> source column: fixed values that must equal the reference's.
NSPL_COLUMNS = {
    "postcode": "pcds",
    "lat": "lat",
    "long": "long",
    "lsoa21cd": "lsoa21cd",
    "msoa21cd": "msoa21cd",
    "county": "cty25cd",
    "lad": "lad25cd",
    "ward": "wd25cd",
}
ODS_COLUMNS = {
    "practice_code": "Code",
    "pcn_name": "Is Partner To - Name",
    "sub_icb_name": "Geographic Primary Care Organisation Name",
    "icb_name": "High Level Health Geography Name",
    "nhser_name": "National Grouping Name",
}
NSPL_VOCAB = (POSTCODE_KEY, *LOCATION_COLUMNS, *POSTCODE_AREA_TYPES)
ODS_VOCAB = (PRACTICE_KEY, *PRACTICE_AREA_TYPES)
LEGACY_NSPL_COLUMNS = ("pcd", "lat", "long", "msoa11", "laua")


class LookupColumnsMissing(Exception):
    """A lookup no longer carries the columns the mapping expects."""


def read_lookup_csv(spark: SparkSession, path: str, typed: dict | None = None,
                    **options) -> DataFrame:
    """Header CSV, all text, then the given casts (lat/long by default)."""
    typed = {"lat": "double", "long": "double"} if typed is None else typed
    r = spark.read.option("header", True).option("inferSchema", False)
    for k, v in options.items():
        r = r.option(k, v)
    df = r.csv(path)
    return df.select(*[F.col(f"`{c}`").cast(typed[c]).alias(c) if c in typed else F.col(f"`{c}`")
                       for c in df.columns])


def mapping_problems(mapper: dict, vocabulary) -> set:
    """Symmetric difference of mapped target names and the vocabulary."""
    return set(mapper) ^ set(vocabulary)


def select_mapped(df: DataFrame, mapper: dict) -> DataFrame:
    """Select and rename by mapper; a missing source column is a
    LookupColumnsMissing error raised at plan time, before any data is read."""
    missing = [src for src in mapper.values() if src not in df.columns]
    if missing:
        raise LookupColumnsMissing(f"lookup lacks columns {missing}")
    return df.select(*[F.col(f"`{src}`").alias(dst) for dst, src in mapper.items()])


def nspl_select(raw: DataFrame) -> DataFrame:
    """P7 + normalised postcode key."""
    out = select_mapped(raw, NSPL_COLUMNS)
    return out.withColumn("postcode", normalise_postcode("postcode"))


def ods_select(raw: DataFrame) -> DataFrame:
    """Organisation lookup under the practice area-type names."""
    return select_mapped(raw, ODS_COLUMNS)


def nspl_england(raw_legacy: DataFrame) -> DataFrame:
    """S4 + F3 + P3: legacy lookup, England only, postcode normalised.

    The filter sits before any join that uses the lookup, so it reaches the
    scan (PushedFilters) and shrinks the join side.
    """
    return (raw_legacy.select(*LEGACY_NSPL_COLUMNS)
            .filter(F.col("laua").startswith("E"))
            .select(normalise_postcode("pcd").alias("POSTCODE"), "lat", "long", "msoa11", "laua"))


def dedup_on_key(lookup: DataFrame, key: str) -> DataFrame:
    """One row per key, deterministic (the smallest row), so a repeated
    postcode cannot fan out a left join."""
    others = [c for c in lookup.columns if c != key]
    return (lookup.filter(F.col(key).isNotNull())
            .groupBy(key).agg(F.min(F.struct(*others)).alias("_r"))
            .select(key, *[F.col("_r")[c].alias(c) for c in others]))


def schema_contract(raws: dict[str, DataFrame]) -> DataFrame:
    """Per lookup and mapped column, whether the source column is
    present and how many non-null values it carries; vocabulary mismatches
    are raised immediately."""
    specs = {"nspl": (NSPL_COLUMNS, NSPL_VOCAB), "ods": (ODS_COLUMNS, ODS_VOCAB)}
    parts = []
    for name, raw in raws.items():
        mapper, vocab = specs[name]
        bad = mapping_problems(mapper, vocab)
        if bad:
            raise TypeError(f"{name} mapper and vocabulary differ: {sorted(bad)}")
        have = set(raw.columns)
        counts = raw.agg(*[(F.count(F.col(f"`{src}`")) if src in have else F.lit(0).cast("long")).alias(dst)
                           for dst, src in mapper.items()])
        stacked = counts.select(F.explode(F.array(*[
            F.struct(F.lit(name).alias("lookup"), F.lit(dst).alias("target"),
                     F.lit(src).alias("source"), F.lit(src in have).alias("present"),
                     F.col(dst).alias("non_null")) for dst, src in mapper.items()])).alias("r")).select("r.*")
        parts.append(stacked)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def landed_columns(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(file, position, column, first_value) of each landed CSV: its
    header and its first row, before a mapping for it is written. Only the
    files' first lines are read."""
    rows = first_lines(spark, path, glob, 2)
    names, values = F.element_at("lines", 1), F.try_element_at("lines", F.lit(2))
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.posexplode(names).alias("position", "column"), values.alias("v")) \
        .select("file", "position", "column", F.get("v", F.col("position")).alias("first_value"))
