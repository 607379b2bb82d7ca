"""Nearest practices and inverse-distance weighting.

No cross product of areas and practices is formed for the k-nearest and
distance-limit modes:

* practices are first folded to distinct points per partition (year):
  ``n`` practices and the sum of their values at each location, so a
  location shared by many practices is one row;
* the search goes down a grid quadtree, level by level: practices counted
  per cell bound a target's k-th distance from above, and cells beyond the
  bound are left, so a crowded cluster is refined until about k locations
  remain per target (``candidate_cells``);
* ranks follow ``rank()`` (ties share a rank, so ties at the k-th distance
  are kept): rank = 1 + practices strictly closer.

With only a distance limit the grid cell is the limit and the join covers
the 3x3 block. IDW over *all* practices is by definition every pair; it is
computed as per-task partial sums (numpy over an Arrow batch against the
size-checked area set) reduced by a groupBy, so pairs are never emitted.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rxatlas.session import materialize

LEVELS, STEP = 30, 3
#: Candidate locations per wanted neighbour at which a target's search stops refining.
SETTLED = 8
MAX_TARGETS_PER_BLOCK = 50_000
#: Distances held at once by a task of ``idw_all``.
MAX_DISTANCES = 4_000_000
#: Groups (years) whose sums a task holds.
MAX_HELD_GROUPS = 64


def fold_points(sources: DataFrame, part_cols: list[str], value: str) -> DataFrame:
    """Distinct locations per partition with practice count and value sum."""
    return sources.groupBy(*part_cols, "x", "y").agg(
        F.count("*").alias("n"), F.sum(value).alias("sz"))


def _frame(points: DataFrame, targets: DataFrame):
    """Joint bounding box of locations and targets (one scalar job)."""
    xy = points.select("x", "y").unionByName(targets.select(F.col("tx").alias("x"), F.col("ty").alias("y")))
    b = xy.agg(F.min("x").alias("a"), F.min("y").alias("b"),
               F.max("x").alias("c"), F.max("y").alias("d")).first()
    if b.a is None:
        return None
    s0 = max(b.c - b.a, b.d - b.b) * 1.000001 + 1.0
    return b.a, b.b, s0


def _offsets(r: int):
    return F.explode(F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy"))
                               for i in range(-r, r + 1) for j in range(-r, r + 1)]))


def _rank_and_keep(cand: DataFrame, keys: list[str], k: int | None) -> DataFrame:
    # rank of a location = 1 + practices strictly closer: the RANGE frame sums
    # every practice at distance <= d, the tie window those at exactly d.
    w_cum = Window.partitionBy(*keys).orderBy("d2").rangeBetween(Window.unboundedPreceding, 0)
    ties = Window.partitionBy(*keys, "d2")
    cand = cand.withColumn("rank", F.sum("n").over(w_cum) - F.sum("n").over(ties) + 1)
    return cand if k is None else cand.filter(F.col("rank") <= k)


def knn_points(targets: DataFrame, points: DataFrame, part_cols: list[str], k: int,
               levels: int = LEVELS) -> DataFrame:
    """Per (partition, target): folded locations within the k nearest, ties
    kept. Columns: part_cols, code, x, y, n, sz, d2, rank."""
    points = materialize(points)  # folded locations: small, read once a level below
    fr = _frame(points, targets)
    if fr is None:
        return points.limit(0).select(*part_cols, F.lit(None).cast("string").alias("code"),
                                      "x", "y", "n", "sz", F.lit(0.0).alias("d2"),
                                      F.lit(0).cast("bigint").alias("rank"))
    cells, located = candidate_cells(targets, points, part_cols, k, fr, levels)
    dx, dy = F.col("x") - F.col("tx"), F.col("y") - F.col("ty")
    cand = (cells.join(located, part_cols + ["cx", "cy"])
            .select(*part_cols, "code", "x", "y", "n", "sz", (dx * dx + dy * dy).alias("d2")))
    return _rank_and_keep(cand, part_cols + ["code"], k)


def candidate_cells(targets: DataFrame, points: DataFrame, part_cols: list[str], k: int, frame: tuple,
                    levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """The grid cells that can hold one of the k nearest of each target, and the
    locations with their cell at the same level.

    From one cell over everything, each round replaces a target's cells by
    their occupied descendants ``STEP`` levels down. The practices of cells in
    ascending order of their farthest point give an upper bound of the k-th
    distance; cells whose nearest point lies beyond it are left. Rounds end
    when every target's cells hold at most ``SETTLED * k`` locations, or at
    the finest level.
    """
    ox, oy, s0 = frame
    side = s0 / (2 ** levels)
    fine = points.select("*", F.floor((F.col("x") - ox) / side).cast("bigint").alias("fx"),
                         F.floor((F.col("y") - oy) / side).cast("bigint").alias("fy"))
    zero = F.lit(0).cast("bigint")
    cells, keys = targets.select("code", "tx", "ty", zero.alias("px"), zero.alias("py")), ["px", "py"]
    for level in range(STEP, levels + 1, STEP):
        located = fine.select(*part_cols, "x", "y", "n", "sz",
                              F.expr(f"shiftright(fx, {levels - level})").alias("cx"),
                              F.expr(f"shiftright(fy, {levels - level})").alias("cy"))
        counts = (located.groupBy(*part_cols, "cx", "cy").agg(F.sum("n").alias("cnt"), F.count("*").alias("places"))
                  .select("*", F.expr(f"shiftright(cx, {STEP})").alias("px"), F.expr(f"shiftright(cy, {STEP})").alias("py")))
        s = s0 / (2 ** level)
        lox, loy = ox + F.col("cx") * s - F.col("tx"), oy + F.col("cy") * s - F.col("ty")
        near = F.hypot(F.greatest(F.lit(0.0), lox, -(lox + s)), F.greatest(F.lit(0.0), loy, -(loy + s)))
        far = F.hypot(F.greatest(F.abs(lox), F.abs(lox + s)), F.greatest(F.abs(loy), F.abs(loy + s)))
        inner = cells.join(counts, keys).select(*part_cols, "code", "tx", "ty", "cx", "cy", "cnt", "places",
                                                near.alias("near"), far.alias("far"))
        w = Window.partitionBy(*part_cols, "code")
        upto = w.orderBy("far").rangeBetween(Window.unboundedPreceding, 0)
        bound = F.min(F.when(F.col("upto") >= k, F.col("far"))).over(w)
        # the slack covers rounding where a location lies on a cell's border
        kept = materialize(inner.withColumn("upto", F.sum("cnt").over(upto)).withColumn("bound", bound)
                           .filter(F.col("bound").isNull() | (F.col("near") <= F.col("bound") + 1e-9 * s0))
                           .select(*part_cols, "code", "tx", "ty", "cx", "cy", "places"))
        most = kept.groupBy(*part_cols, "code").agg(F.sum("places").alias("m")).agg(F.max("m")).first()[0] or 0
        if most <= SETTLED * k:
            break
        cells = kept.withColumnsRenamed({"cx": "px", "cy": "py"}).drop("places")
        keys = [*part_cols, "px", "py"]
    return kept.drop("places"), located


def limit_points(targets: DataFrame, points: DataFrame, part_cols: list[str],
                 limit: float) -> DataFrame:
    """F11 alone: locations within ``limit`` of each target (3x3 cells of
    side ``limit``, equi-join on the cell)."""
    cx = F.floor(F.col("x") / limit).cast("bigint")
    cy = F.floor(F.col("y") / limit).cast("bigint")
    pts = points.select(*part_cols, "x", "y", "n", "sz", cx.alias("cx"), cy.alias("cy"))
    tq = (targets.select("code", "tx", "ty", F.floor(F.col("tx") / limit).cast("bigint").alias("tcx"),
                         F.floor(F.col("ty") / limit).cast("bigint").alias("tcy"), _offsets(1).alias("o"))
          .select("code", "tx", "ty", (F.col("tcx") + F.col("o.dx")).alias("cx"),
                  (F.col("tcy") + F.col("o.dy")).alias("cy")))
    dx, dy = F.col("x") - F.col("tx"), F.col("y") - F.col("ty")
    cand = (tq.join(pts, ["cx", "cy"]).withColumn("d2", dx * dx + dy * dy)
            .filter(F.col("d2") <= F.lit(float(limit)) ** 2)
            .select(*part_cols, "code", "x", "y", "n", "sz", "d2"))
    return _rank_and_keep(cand, part_cols + ["code"], None)


def neighbour_points(targets: DataFrame, points: DataFrame, part_cols: list[str],
                     k: int | None = None, distance_limit: float | None = None) -> DataFrame:
    """F10/F11 combined as in the reference: first the k-th distance mask,
    then the distance limit. ``k`` or ``distance_limit`` of 0/None is off."""
    if k:
        kept = knn_points(targets, points, part_cols, k)
        if distance_limit:
            kept = kept.filter(F.col("d2") <= F.lit(float(distance_limit)) ** 2)
        return kept
    if distance_limit:
        return limit_points(targets, points, part_cols, distance_limit)
    raise ValueError("neighbour_points needs k or distance_limit; use idw_all for every practice")


def idw_from_points(kept: DataFrame, keys: list[str], exact_hit: str = "null") -> DataFrame:
    """sum(z/d) / sum(1/d) per key. A location at distance 0 gives null
    (the reference's inf/inf) or, with ``exact_hit='value'``, the mean value
    of the practices there."""
    d = F.sqrt("d2")
    pos = F.col("d2") > 0
    g = kept.groupBy(*keys).agg(
        F.sum(F.when(pos, F.col("sz") / d)).alias("_num"),
        F.sum(F.when(pos, F.col("n") / d)).alias("_den"),
        F.sum(F.when(~pos, F.col("sz"))).alias("_hz"),
        F.sum(F.when(~pos, F.col("n"))).alias("_hn"))
    hit = F.col("_hn").isNotNull()
    at_hit = F.try_divide(F.col("_hz"), F.col("_hn")) if exact_hit == "value" else F.lit(None).cast("double")
    return g.select(*keys, F.when(hit, at_hit).otherwise(F.try_divide("_num", "_den")).alias("value"))


def idw_weights(kept: DataFrame, keys: list[str]) -> DataFrame:
    """Each kept location's weight (1/d normalised to sum 1 over the
    key); per practice weight = location weight / n. Null where the key has
    an exact hit (the reference's NaN)."""
    w = Window.partitionBy(*keys)
    inv = F.when(F.col("d2") > 0, 1.0 / F.sqrt("d2"))
    den = F.sum(F.col("n") * inv).over(w)
    hit = F.max((F.col("d2") == 0).cast("int")).over(w) == 1
    return kept.withColumn("weight", F.when(hit, F.lit(None).cast("double")).otherwise(inv / den))


def idw_all(targets: DataFrame, points: DataFrame, part_cols: list[str],
            exact_hit: str = "null", block: int = MAX_TARGETS_PER_BLOCK) -> DataFrame:
    """A9 with neither k nor a limit: every practice weighs on every area.

    Areas are shipped to the tasks in blocks of at most ``block`` (their
    count is checked; areas are a bounded administrative set); each task
    reduces its locations to partial sums per (partition, area), and a groupBy
    adds the partials. Output: part_cols, code, value.
    """
    spark = points.sparkSession
    n_t = targets.count()
    outs = []
    part_schema = ", ".join(f"{c} {t}" for c, t in points.select(*part_cols).dtypes)
    schema = f"{part_schema}, code string, num double, den double, hz double, hn double"
    for start in range(0, max(n_t, 1), block):
        tb = (targets.select("code", "tx", "ty").orderBy("code").offset(start).limit(block)
              .toPandas())
        bc = spark.sparkContext.broadcast((tb["code"].to_numpy(), tb["tx"].to_numpy(float),
                                           tb["ty"].to_numpy(float)))

        def partial(batches, _bc=bc, _pc=tuple(part_cols)):
            codes, tx, ty = _bc.value
            sums: dict[tuple, np.ndarray] = {}

            def rows():
                for key, x in sums.items():
                    out = pd.DataFrame({"code": codes, "num": x[0], "den": x[1], "hz": x[2], "hn": x[3]})
                    for c, v in zip(_pc, key):
                        out[c] = v
                    yield out[[*_pc, "code", "num", "den", "hz", "hn"]]

            for pdf in batches:
                if pdf.empty:
                    continue
                for key, g in pdf.groupby(list(_pc), sort=False):
                    own = sums.setdefault(key if isinstance(key, tuple) else (key,), np.zeros((4, len(tx))))
                    step = max(1, MAX_DISTANCES // max(1, len(tx)))
                    for at in range(0, len(g), step):
                        part = g.iloc[at:at + step]
                        d = np.hypot(part["x"].to_numpy()[:, None] - tx[None, :],
                                     part["y"].to_numpy()[:, None] - ty[None, :])
                        n = part["n"].to_numpy(float)[:, None]
                        sz = part["sz"].to_numpy(float)[:, None]
                        zero = d == 0
                        with np.errstate(divide="ignore", invalid="ignore"):
                            inv = np.where(zero, 0.0, 1.0 / d)
                        for i, x in enumerate((sz * inv, n * inv, np.where(zero, sz, 0.0), np.where(zero, n, 0.0))):
                            own[i] += x.sum(0)
                if len(sums) > MAX_HELD_GROUPS:
                    yield from rows()
                    sums = {}
            yield from rows()

        outs.append(points.select(*part_cols, "x", "y", "n", "sz").mapInPandas(partial, schema))
    parts = outs[0]
    for o in outs[1:]:
        parts = parts.unionByName(o)
    g = parts.groupBy(*part_cols, "code").agg(*[F.sum(c).alias(c) for c in ("num", "den", "hz", "hn")])
    hit = F.col("hn") > 0
    at_hit = F.try_divide(F.col("hz"), F.col("hn")) if exact_hit == "value" else F.lit(None).cast("double")
    return g.select(*part_cols, "code",
                    F.when(hit, at_hit).otherwise(F.try_divide("num", "den")).alias("value"))


def all_distances(targets: DataFrame, points: DataFrame, key: str, block: int = MAX_TARGETS_PER_BLOCK) -> DataFrame:
    """J4 whole: (code, ``key``, distance) of every area and every point (x, y).

    The result has a row for each pair, as asked; the areas, a bounded
    administrative set, go to the tasks in blocks of at most ``block`` and the
    points stay where they are. For neighbours only, see :func:`limit_points`.
    """
    spark, outs = points.sparkSession, []
    kind = dict(points.dtypes)[key]
    for start in range(0, max(targets.count(), 1), block):
        tb = targets.select("code", "tx", "ty").orderBy("code").offset(start).limit(block).toPandas()
        bc = spark.sparkContext.broadcast((tb["code"].to_numpy(), tb["tx"].to_numpy(float), tb["ty"].to_numpy(float)))

        def measure(batches, _bc=bc):
            codes, tx, ty = _bc.value
            step = max(1, MAX_DISTANCES // max(1, len(tx)))
            for pdf in batches:
                for at in range(0, len(pdf), step):
                    part = pdf.iloc[at:at + step]
                    d = np.hypot(part["x"].to_numpy(float)[:, None] - tx[None, :], part["y"].to_numpy(float)[:, None] - ty[None, :])
                    yield pd.DataFrame({"code": np.tile(codes, len(part)), key: np.repeat(part[key].to_numpy(), len(tx)), "distance": d.ravel()})

        outs.append(points.select(key, "x", "y").mapInPandas(measure, f"code string, `{key}` {kind}, distance double"))
    out = outs[0]
    for o in outs[1:]:
        out = out.union(o)
    return out


def interpolate(targets: DataFrame, sources: DataFrame, part_cols: list[str], value: str,
                k: int | None = None, distance_limit: float | None = None,
                exact_hit: str = "null") -> DataFrame:
    """knn_idw as one call: (part_cols, code, value)."""
    pts = fold_points(sources, part_cols, value)
    if not k and not distance_limit:
        return idw_all(targets, pts, part_cols, exact_hit)
    kept = neighbour_points(targets, pts, part_cols, k, distance_limit)
    return idw_from_points(kept, part_cols + ["code"], exact_hit)
