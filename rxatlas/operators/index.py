"""The practice index.

One lazy plan from prescription rows to the practice-year index:

    rows --P9--> flagged --A3 groupBy(practice, year, month, postcode)-->
    month counts --F1,F2--> kept --A4 groupBy(practice, year, postcode)-->
    year counts --P10--> percent --A5/P11--> clipped --A6/P12--> z --P13--> index

Statistics are per YEAR (W3), computed as small aggregates and broadcast
back (their size is bounded by the number of years), so many years run in
one job and no window spans a whole year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxatlas.functions.text import month_text, normalise_postcode, year_text
from rxatlas.operators.illness import MANY_NAMES, IllnessSpec, flag_items_automaton, illness_item_columns
from rxatlas.operators.quantiles import exact_percentiles
from rxatlas.session import materialize

KEYS_MONTH = ["PRACTICE_CODE", "YEAR", "MONTH", "POSTCODE"]
KEYS_YEAR = ["PRACTICE_CODE", "YEAR", "POSTCODE"]
INDEX_COLUMN = "loneliness_prac"


def perc(c: str) -> str:
    return c + "_perc"


def trim(c: str) -> str:
    return c + "_perc_trim"


def zscore(c: str) -> str:
    return c + "_perc_trim_zscore"


def flag_items(epd: DataFrame, spec: list[IllnessSpec]) -> DataFrame:
    """P9 + P2/P5/D7: per-row illness items with practice keys. Long lists of
    names are matched in one pass by an automaton."""
    keys = [F.col("PRACTICE_CODE"), normalise_postcode("POSTCODE").alias("POSTCODE"),
            year_text("YEAR_MONTH").alias("YEAR"), month_text("YEAR_MONTH").alias("MONTH")]
    if sum(len(s.medications) for s in spec) > MANY_NAMES:
        return flag_items_automaton(epd.select(*keys, "BNF_DESCRIPTION", "ITEMS"), spec).select(
            "PRACTICE_CODE", "POSTCODE", "YEAR", "MONTH", *[s.column for s in spec], "ITEMS")
    return epd.select(*keys, *illness_item_columns(spec), "ITEMS")


def practice_month_counts(flagged: DataFrame, spec: list[IllnessSpec]) -> DataFrame:
    """A3 (+F13: pandas drops null group keys)."""
    cols = [s.column for s in spec] + ["ITEMS"]
    keyed = flagged.filter(F.col("PRACTICE_CODE").isNotNull() & F.col("YEAR").isNotNull()
                           & F.col("MONTH").isNotNull() & F.col("POSTCODE").isNotNull())
    return keyed.groupBy(*KEYS_MONTH).agg(*[F.sum(c).alias(c) for c in cols])


def _row_sum(cols) -> F.Column:
    out = F.lit(0).cast("bigint")
    for c in cols:
        out = out + F.coalesce(F.col(c), F.lit(0))
    return out


def practice_month_kept(counts: DataFrame, spec: list[IllnessSpec], min_items: int = 500,
                        clinic_illness: str = "addiction") -> DataFrame:
    """F1 + F2, per month and over every illness of ``spec`` (D9): drop
    practice-months with fewer than ``min_items`` matched items, and those
    where ``clinic_illness`` outweighs all the others."""
    allc = [s.column for s in spec]
    others = [c for c in allc if c != clinic_illness]
    out = counts.filter(_row_sum(allc) >= min_items)
    if clinic_illness in allc:
        out = out.filter(_row_sum(others) >= F.col(clinic_illness))
    return out


def practice_year_counts(kept: DataFrame, index_spec: list[IllnessSpec]) -> DataFrame:
    """A4: roll kept months up to the year for the index illnesses + ITEMS."""
    cols = [s.column for s in index_spec] + ["ITEMS"]
    return kept.groupBy(*KEYS_YEAR).agg(*[F.sum(c).alias(c) for c in cols])


def illness_percent(year_counts: DataFrame, index_spec: list[IllnessSpec]) -> DataFrame:
    """P10: 100 * illness / ITEMS; ITEMS = 0 gives null, not an error."""
    return year_counts.select(
        "*", *[F.try_divide(100.0 * F.col(s.column), F.col("ITEMS")).alias(perc(s.column))
               for s in index_spec])


def _long(df: DataFrame, index_spec, col_of) -> DataFrame:
    return df.select("YEAR", F.explode(F.array(*[
        F.struct(F.lit(s.column).alias("illness"), F.col(col_of(s.column)).alias("value"))
        for s in index_spec])).alias("r")).select("YEAR", "r.*")


def illness_quantiles(pct: DataFrame, index_spec: list[IllnessSpec], lower: float = 0.005,
                      upper: float = 0.995) -> DataFrame:
    """A5: exact interpolated percentiles of each percentage column per YEAR
    (long: YEAR, illness, lower, upper). Groups are years x illnesses."""
    long = _long(pct, index_spec, perc)
    q = exact_percentiles(long, ["YEAR", "illness"], "value", [lower, upper], small_groups=True)
    return q.groupBy("YEAR", "illness").agg(
        F.max(F.when(F.col("p") == lower, F.col("value"))).alias("lower"),
        F.max(F.when(F.col("p") == upper, F.col("value"))).alias("upper"))


def _wide(long_stats: DataFrame, index_spec, fields: list[str]) -> DataFrame:
    return long_stats.groupBy("YEAR").agg(*[
        F.max(F.when(F.col("illness") == s.column, F.col(f))).alias(f"{s.column}__{f}")
        for s in index_spec for f in fields])


def illness_clip(pct: DataFrame, index_spec: list[IllnessSpec], lower: float = 0.005,
                 upper: float = 0.995) -> DataFrame:
    """Clip each percentage to its year's bounds; null stays null
    (``greatest``/``least`` skip nulls, so the guard is needed)."""
    bounds = _wide(illness_quantiles(pct, index_spec, lower, upper), index_spec, ["lower", "upper"])
    j = pct.join(F.broadcast(bounds), "YEAR", "left")  # one row per year
    trims = []
    for s in index_spec:
        x = F.col(perc(s.column))
        lo, hi = F.col(f"{s.column}__lower"), F.col(f"{s.column}__upper")
        trims.append(F.when(x.isNotNull(), F.least(F.greatest(x, lo), hi)).alias(trim(s.column)))
    return j.select(*pct.columns, *trims)


def illness_zscore(clipped: DataFrame, index_spec: list[IllnessSpec]) -> DataFrame:
    """P12 + A6: (x - mean) / population std per year; std 0 gives null."""
    stats = clipped.groupBy("YEAR").agg(*[
        e for s in index_spec for e in (F.avg(trim(s.column)).alias(f"{s.column}__mean"),
                                        F.stddev_pop(trim(s.column)).alias(f"{s.column}__std"))])
    j = clipped.join(F.broadcast(stats), "YEAR", "left")  # one row per year
    zs = [F.try_divide(F.col(trim(s.column)) - F.col(f"{s.column}__mean"),
                       F.col(f"{s.column}__std")).alias(zscore(s.column)) for s in index_spec]
    return j.select(*clipped.columns, *zs)


def composite_index(z: DataFrame, index_spec: list[IllnessSpec]) -> DataFrame:
    """Row sum of the z-scores, missing ones count 0."""
    total = F.lit(0.0)
    for s in index_spec:
        total = total + F.coalesce(F.col(zscore(s.column)), F.lit(0.0))
    return z.withColumn(INDEX_COLUMN, total)


def practice_year_table(epd: DataFrame, spec: list[IllnessSpec], index_spec: list[IllnessSpec],
                        min_items: int = 500) -> DataFrame:
    """A3 -> F1/F2 -> A4."""
    counts = practice_month_counts(flag_items(epd, spec), spec)
    return practice_year_counts(practice_month_kept(counts, spec, min_items), index_spec)


def practice_index(epd: DataFrame, spec: list[IllnessSpec], index_spec: list[IllnessSpec],
                   min_items: int = 500, lower_clip: float = 0.005,
                   upper_clip: float = 0.995, materialized: bool = True) -> DataFrame:
    """C2 without the geography join: T5 per practice, year and postcode.

    The practice-year percentages (one row per practice and year, small next
    to the prescription rows) are read by the percentile, clip, mean/std and
    z passes; with ``materialized`` they are checkpointed once, so the
    prescription scan and its two aggregations run exactly once and a lost
    executor does not send the job back to the raw rows.
    """
    yc = practice_year_table(epd, spec, index_spec, min_items)
    pct = illness_percent(yc, index_spec)
    if materialized:
        pct = materialize(pct)
    clipped = illness_clip(pct, index_spec, lower_clip, upper_clip)
    if materialized:
        clipped = materialize(clipped)
    z = illness_zscore(clipped, index_spec)
    return composite_index(z, index_spec)


def attach_geography(index: DataFrame, lookup: DataFrame, key: str = "POSTCODE") -> DataFrame:
    """Left join the (deduplicated) postcode lookup. The lookup holds
    every postcode, so no broadcast is forced: AQE picks broadcast or
    sort-merge from its runtime size."""
    from rxatlas.sources.lookups import dedup_on_key
    return index.join(dedup_on_key(lookup, key), key, "left")
