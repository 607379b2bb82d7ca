"""Area aggregation (A7, A8, J2, J3, O1) and area mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxatlas.functions.text import normalise_postcode
from rxatlas.schemas import area_key


def years_of(df: DataFrame, col: str = "YEAR") -> list:
    """Distinct years present (a calendar-bounded handful) for the area spine."""
    return sorted(r[0] for r in df.select(col).distinct().collect())


def area_year_spine(areas: DataFrame, years: list, year_col: str = "YEAR") -> DataFrame:
    """Every area for every year, so areas without practices survive as nulls."""
    return areas.select("code", F.explode(F.array(*[F.lit(y) for y in years])).alias(year_col))


def area_mean_index(index_geo: DataFrame, areas: DataFrame, area_col: str,
                    score_cols: list[str], years: list | None = None,
                    items_col: str = "ITEMS") -> DataFrame:
    """A7 + A8 + J2 + J3 in one groupBy and one join.

    Mean of each score column per (year, area code), their sum as the area
    index (a missing mean counts 0), ITEMS summed as support. Practices with
    no area code are left out (F13); areas with no practice keep nulls.
    """
    g = (index_geo.filter(F.col(area_col).isNotNull())
         .groupBy("YEAR", F.col(area_col).alias("code"))
         .agg(*[F.avg(c).alias(c) for c in score_cols], F.sum(items_col).alias(items_col)))
    total = F.lit(0.0)
    for c in score_cols:
        total = total + F.coalesce(F.col(c), F.lit(0.0))
    g = g.select("YEAR", "code", total.alias("loneliness"), items_col, *score_cols)
    years = years if years is not None else years_of(index_geo)
    spine = area_year_spine(areas, years)
    return spine.join(g, ["YEAR", "code"], "left")


def order_areas(df: DataFrame, value: str = "loneliness") -> DataFrame:
    """O1: descending, missing last, code as a tie-break so order is total."""
    return df.orderBy(F.col("YEAR"), F.desc_nulls_last(value), F.col("code"))


def map_to_area(grouped: DataFrame, mapper: DataFrame, area_type: str,
                medicines: DataFrame) -> DataFrame:
    """C5 (J6 + A13): per practice, year, postcode and area, items of the
    selected medicines and the practice's items over all medicines, in one
    pass. The key (postcode or practice code) follows the area type.

    ``medicines`` is the (broadcast-checked) medicine list; it is joined as a
    flag rather than a filter so the grand total sees every medicine.
    """
    key = area_key(area_type)
    if key == "postcode":
        grouped = grouped.withColumn("postcode", normalise_postcode("postcode"))
    m = mapper.select(key, area_type).filter(F.col(key).isNotNull())
    from rxatlas.sources.lookups import dedup_on_key
    m = dedup_on_key(m, key)
    from rxatlas.operators.illness import check_broadcastable
    meds = check_broadcastable(medicines.select("medication").distinct()
                               .withColumn("_sel", F.lit(True)))
    j = grouped.join(meds, "medication", "left").join(m, key, "left")
    return (j.groupBy("practice_code", "year", "postcode", area_type)
            .agg(F.coalesce(F.sum(F.when(F.col("_sel"), F.col("total_items"))), F.lit(0))
                 .cast("bigint").alias("total_items"),
                 F.sum("total_items").alias("grand_total")))


def area_totals(grouped: DataFrame, mapper: DataFrame, area_type: str, medicines: DataFrame) -> DataFrame:
    """(area_type, area, year, total_items, grand_total) for any area type;
    practices or postcodes without an area come under null."""
    m = map_to_area(grouped, mapper, area_type, medicines)
    g = m.groupBy(F.col(area_type).alias("area"), "year").agg(F.sum("total_items").alias("total_items"), F.sum("grand_total").alias("grand_total"))
    return g.select(F.lit(area_type).alias("area_type"), "area", "year", "total_items", "grand_total")
