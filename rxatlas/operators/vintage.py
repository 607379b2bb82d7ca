"""Does a geography's vintage fit the data year it is used for?

Area codes are drawn up anew from time to time (the 2011 and the 2021 areas of
one type differ), and each vintage stands for a span of years. A use of a
vintage outside its span is rejected, with the vintage that would have fitted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxatlas.operators.illness import check_broadcastable

VINTAGES = "area_type string, vintage string, valid_from int, valid_to int"


def vintage_check(uses: DataFrame, vintages: DataFrame) -> DataFrame:
    """(area_type, vintage, year, accepted, reason, fitting) per distinct row of
    ``uses`` (area_type, vintage, year).

    ``vintages`` has VINTAGES: years valid_from to valid_to, both included, null
    open. reason: ``fits``, ``too_new`` (data from before the vintage),
    ``too_old`` (from after it), ``unknown`` (no such vintage), ``no_year``.
    fitting: the vintage of the type that covers the year, the latest if several
    do, null if none. The interval join runs inside a type, which has a handful
    of vintages.
    """
    uses = uses.select("area_type", "vintage", F.col("year").cast("int").alias("year")).distinct()
    v = check_broadcastable(vintages.select("area_type", F.col("vintage").alias("v"), "valid_from", "valid_to"))
    j = uses.join(v, "area_type", "left")
    after = F.col("valid_from").isNull() | (F.col("year") >= F.col("valid_from"))
    until = F.col("valid_to").isNull() | (F.col("year") <= F.col("valid_to"))
    covers = F.col("v").isNotNull() & after & until
    own = F.col("v").eqNullSafe(F.col("vintage")) & F.col("v").isNotNull()
    start = F.coalesce("valid_from", F.lit(-2147483648))
    g = j.groupBy("area_type", "vintage", "year").agg(
        F.max(own).alias("known"), F.max(own & covers).alias("fits"), F.max(own & ~after).alias("early"),
        F.max(F.when(covers, F.struct(start.alias("s"), F.col("v").alias("v")))).alias("best"))
    reason = (F.when(F.col("year").isNull(), "no_year").when(~F.coalesce("known", F.lit(False)), "unknown").when(F.col("fits"), "fits")
              .when(F.col("early"), "too_new").otherwise("too_old"))
    return g.select("area_type", "vintage", "year", (reason == "fits").alias("accepted"), reason.alias("reason"),
                    F.when(F.col("year").isNotNull(), F.col("best.v")).alias("fitting"))


def keep_fitting_years(df: DataFrame, checked: DataFrame, year_col: str, area_type: str, vintage: str) -> tuple[DataFrame, DataFrame]:
    """``df`` without the years that ``checked`` rejects for a geography, and the
    reject list (year, reason, fitting, n_rows)."""
    bad = checked.where((F.col("area_type") == area_type) & (F.col("vintage") == vintage) & ~F.col("accepted"))
    bad = check_broadcastable(bad.select(F.col("year").alias("_year"), "reason", "fitting"))
    year = F.col(year_col).cast("int")
    rejects = df.join(bad, year == F.col("_year")).groupBy(F.col("_year").alias("year"), "reason", "fitting").agg(F.count("*").alias("n_rows"))
    return df.join(bad, year == F.col("_year"), "left_anti"), rejects
