"""A5: exact percentiles with linear interpolation, without gathering a group;
opt-in approximate ones from stored sketches.

Spark's ``percentile`` aggregate holds every value of a group in one task.
Here a group may hold a third of all rows, so the exact value is found in
two distributed passes:

1. per group: n, and ``percentile_approx`` at p +- 3/accuracy. The sketch's
   rank error is at most n/accuracy, so the two values bracket the ranks
   floor((n-1)p) and ceil((n-1)p).
2. per (group, p): values below the bracket are counted (one null key, which
   partial aggregation collapses map-side); values inside are counted per
   distinct value. The bracket holds about 6n/accuracy rows, so a running
   sum over it is small. The two ranks are then read off and interpolated.

If the sketch bound were ever violated the bracket test fails and that
(group, p) falls back to the group's [min, max]; the result stays exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rxatlas.session import materialize

DEFAULT_ACCURACY = 10_000


def exact_percentiles(df: DataFrame, group_cols: list[str], value: str, probs: list[float],
                      accuracy: int = DEFAULT_ACCURACY, small_groups: bool = False) -> DataFrame:
    """Return (group_cols..., p, value) with the percentile of ``value`` at
    each ``p``, nulls and NaN ignored, interpolated like numpy/pandas.

    ``small_groups`` declares that the number of groups is bounded (years,
    illnesses), so the per-group bracket table is broadcast to the scan.
    """
    eps = 3.0 / accuracy
    base = df.select(*[F.col(g) for g in group_cols], F.col(value).cast("double").alias("_v")) \
        .filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    lo_p = [max(0.0, p - eps) for p in probs]
    hi_p = [min(1.0, p + eps) for p in probs]
    stats = base.groupBy(*group_cols).agg(
        F.count("*").alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.percentile_approx("_v", F.array(*[F.lit(x) for x in lo_p]), accuracy).alias("_lo"),
        F.percentile_approx("_v", F.array(*[F.lit(x) for x in hi_p]), accuracy).alias("_hi"))
    pidx = F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("_i", "_p")
    br = stats.select(*group_cols, "_n", "_min", "_max", "_lo", "_hi", pidx)
    pos = (F.col("_n") - 1) * F.col("_p")
    br = br.select(*group_cols, "_i", "_p", "_n", "_min", "_max",
                   F.col("_lo")[F.col("_i")].alias("_L"), F.col("_hi")[F.col("_i")].alias("_H"),
                   pos.alias("_pos"), F.floor(pos).cast("long").alias("_r0"),
                   F.ceil(pos).cast("long").alias("_r1"))
    brj = F.broadcast(br) if small_groups else br
    keys = [*group_cols, "_i", "_p", "_pos", "_r0", "_r1"]
    # one row per distinct value inside the bracket, plus one null-valued row
    # counting everything below it; the hot "below" key combines map-side
    counted = (base.join(brj, group_cols)
               .filter(F.col("_v") <= F.col("_H"))
               .groupBy(*keys, F.when(F.col("_v") >= F.col("_L"), F.col("_v")).alias("_val"))
               .agg(F.count("*").alias("_c")))
    w = Window.partitionBy(*keys).orderBy(F.col("_val").asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (counted.withColumn("_end", F.sum("_c").over(w) - 1)
              .withColumn("_start", F.col("_end") - F.col("_c") + 1))
    covers = lambda r: (F.col("_start") <= F.col(r)) & (F.col(r) <= F.col("_end"))
    # one row per group and p: read twice below
    picks = materialize(ranked.groupBy(*keys).agg(
        F.min(F.when(covers("_r0"), F.col("_val"))).alias("_v0"),
        F.min(F.when(covers("_r1"), F.col("_val"))).alias("_v1")))
    frac = F.col("_pos") - F.col("_r0")
    interp = F.when(F.col("_r0") == F.col("_r1"), F.col("_v0")) \
        .otherwise(F.col("_v0") + (F.col("_v1") - F.col("_v0")) * frac)
    ok = F.col("_v0").isNotNull() & F.col("_v1").isNotNull()
    exact = picks.filter(ok).select(*group_cols, F.col("_p").alias("p"), interp.alias(value))
    failed = picks.filter(~ok).select(*group_cols, "_i", "_p", "_pos", "_r0", "_r1")
    if failed.limit(1).count() == 0:
        return exact
    return exact.unionByName(_fallback(base, failed, group_cols, value))


def _fallback(base: DataFrame, failed: DataFrame, group_cols, value) -> DataFrame:
    """Whole-group ranks for (group, p) pairs whose bracket missed; empty in
    practice, kept so the result is exact under any sketch behaviour."""
    j = base.join(failed, group_cols)
    w = Window.partitionBy(*group_cols, "_i").orderBy("_v")
    r = j.withColumn("_rk", F.row_number().over(w) - 1)
    picks = r.groupBy(*group_cols, "_i", "_p", "_pos", "_r0", "_r1").agg(
        F.min(F.when(F.col("_rk") == F.col("_r0"), F.col("_v"))).alias("_v0"),
        F.min(F.when(F.col("_rk") == F.col("_r1"), F.col("_v"))).alias("_v1"))
    frac = F.col("_pos") - F.col("_r0")
    interp = F.when(F.col("_r0") == F.col("_r1"), F.col("_v0")) \
        .otherwise(F.col("_v0") + (F.col("_v1") - F.col("_v0")) * frac)
    return picks.select(*group_cols, F.col("_p").alias("p"), interp.alias(value))


# ---- opt-in approximation from stored sketches ------------------------------------

#: Size parameter of a sketch, and the rank error it keeps to (99 % of the time a third of it).
SKETCH_K, SKETCH_RANK_ERROR = 2000, 0.01


def sketch_values(df: DataFrame, group_cols: list[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """(group_cols..., n, sketch): a mergeable quantile sketch of each group's
    values, nulls and NaN left out. A sketch takes some ten kilobytes, however
    many values it stands for, so a month's can be stored with the month."""
    v = df.select(*group_cols, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    return v.groupBy(*group_cols).agg(F.count("*").alias("n"), F.kll_sketch_agg_double("_v", k).alias("sketch"))


def merged_sketches(sketches: DataFrame, group_cols: list[str], k: int = SKETCH_K) -> DataFrame:
    """(group_cols..., n, sketch): stored sketches put together, no value read again."""
    return sketches.groupBy(*group_cols).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketch_percentiles(sketches: DataFrame, group_cols: list[str], probs: list[float]) -> DataFrame:
    """(group_cols..., p, value) off sketches: a value whose rank is within
    SKETCH_RANK_ERROR of p. For the exact figure see :func:`exact_percentiles`."""
    at = [F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value")) for p in probs]
    return sketches.select(*group_cols, F.explode(F.array(*at)).alias("r")).select(*group_cols, "r.p", "r.value")
