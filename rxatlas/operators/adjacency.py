"""Centroids, area adjacency ("not disjoint") and LISA.

Adjacency is found without comparing every pair of areas: polygons are cut
into edges, each edge is assigned to the grid cells it passes through, and edges
meeting in a cell are tested exactly (orientation signs; shared vertices and
collinear overlaps count as touching). Areas that lie wholly inside another
without any edge contact are added by a point-in-polygon test (even-odd over all
rings, so a hole counts as outside). Every area is its own neighbour.

Sizes may differ by any factor, one nation among small areas included. A long
edge is taken in pieces of a cell's length, so its cells follow its length and
not its box: all edges together have at most 1.25 pieces each on average. Boxes
are covered at the level of a cell quadtree where a cell is as large as the box
(four cells at most), and meet smaller ones there.

Boundaries change now and then, a few areas at a time: :func:`update_pairs`
keeps a stored pair table and joins again only what lies near a change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxatlas.operators.illness import check_broadcastable
from rxatlas.session import materialize

RING_MOMENTS = """
aggregate(sequence(0, size({r}) - 2), named_struct('a', 0D, 'mx', 0D, 'my', 0D),
  (acc, i) -> named_struct(
    'a', acc.a + (({r}[i].x - ox) * ({r}[i + 1].y - oy) - ({r}[i + 1].x - ox) * ({r}[i].y - oy)),
    'mx', acc.mx + (({r}[i].x - ox) + ({r}[i + 1].x - ox))
          * (({r}[i].x - ox) * ({r}[i + 1].y - oy) - ({r}[i + 1].x - ox) * ({r}[i].y - oy)),
    'my', acc.my + (({r}[i].y - oy) + ({r}[i + 1].y - oy))
          * (({r}[i].x - ox) * ({r}[i + 1].y - oy) - ({r}[i + 1].x - ox) * ({r}[i].y - oy))))
"""


def centroids(areas: DataFrame) -> DataFrame:
    """Area centroid from signed ring moments, one projection per area.

    Exterior rings add, holes subtract (whatever their winding); parts add.
    Coordinates are offset by the first vertex for precision. A zero-area
    geometry falls back to the mean of its vertices.
    """
    moments = RING_MOMENTS.format(r="r")
    per_ring = f"""
      flatten(transform(parts, p -> transform(p, (r, j) -> named_struct(
         'hole', j > 0, 'm', {moments}))))"""
    signed = """
      aggregate(rings, named_struct('a', 0D, 'mx', 0D, 'my', 0D), (acc, q) -> named_struct(
        'a', acc.a + (CASE WHEN q.hole THEN -1D ELSE 1D END) * abs(q.m.a),
        'mx', acc.mx + (CASE WHEN q.hole THEN -1D ELSE 1D END) * signum(q.m.a) * q.m.mx,
        'my', acc.my + (CASE WHEN q.hole THEN -1D ELSE 1D END) * signum(q.m.a) * q.m.my))"""
    verts = "flatten(flatten(parts))"
    out = (areas.withColumn("ox", F.expr("parts[0][0][0].x")).withColumn("oy", F.expr("parts[0][0][0].y"))
           .withColumn("rings", F.expr(per_ring))
           .withColumn("s", F.expr(signed))
           .withColumn("vx", F.expr(f"aggregate({verts}, 0D, (a, v) -> a + v.x) / size({verts})"))
           .withColumn("vy", F.expr(f"aggregate({verts}, 0D, (a, v) -> a + v.y) / size({verts})")))
    area2 = F.col("s.a")  # twice the area
    cx = F.when(area2 != 0, F.col("ox") + F.col("s.mx") / (3.0 * area2)).otherwise(F.col("vx"))
    cy = F.when(area2 != 0, F.col("oy") + F.col("s.my") / (3.0 * area2)).otherwise(F.col("vy"))
    return out.select("code", cx.alias("cx"), cy.alias("cy"), (F.abs(area2) / 2.0).alias("area"))


def edges(areas: DataFrame) -> DataFrame:
    """Every ring edge as (code, x1, y1, x2, y2)."""
    e = areas.select("code", F.explode(F.flatten("parts")).alias("r"))
    return e.select("code", F.explode(F.expr(
        "transform(sequence(0, size(r) - 2), i -> named_struct("
        "'x1', r[i].x, 'y1', r[i].y, 'x2', r[i + 1].x, 'y2', r[i + 1].y))")).alias("e")) \
        .select("code", "e.*")


def default_cell(edge_df: DataFrame) -> float:
    """Grid side: four times the mean edge length (one scalar aggregate)."""
    m = edge_df.agg(F.avg(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))).first()[0]
    return float(m) * 4.0 if m else 1.0


EDGE_CELLS = """
array_distinct(flatten(transform(sequence(0, n - 1), i -> flatten(transform(
  sequence(cast(floor((least(s.x1 + (s.x2 - s.x1) * i / n, s.x1 + (s.x2 - s.x1) * (i + 1) / n) - {m}) / {g}) as bigint),
           cast(floor((greatest(s.x1 + (s.x2 - s.x1) * i / n, s.x1 + (s.x2 - s.x1) * (i + 1) / n) + {m}) / {g}) as bigint)),
  cx -> transform(
    sequence(cast(floor((least(s.y1 + (s.y2 - s.y1) * i / n, s.y1 + (s.y2 - s.y1) * (i + 1) / n) - {m}) / {g}) as bigint),
             cast(floor((greatest(s.y1 + (s.y2 - s.y1) * i / n, s.y1 + (s.y2 - s.y1) * (i + 1) / n) + {m}) / {g}) as bigint)),
    cy -> named_struct('cx', cx, 'cy', cy)))))))
"""


def edge_cells(e: DataFrame, g: float) -> DataFrame:
    """(code, s, cx, cy): the cells of side ``g`` that each edge's pieces, no
    longer than a cell, touch (with a margin for the pieces' rounded ends)."""
    s = F.struct("x1", "y1", "x2", "y2").alias("s")
    n = F.greatest(F.lit(1), F.ceil(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")) / g).cast("int")).alias("n")
    c = e.select("code", s, n).select("code", "s", F.explode(F.expr(EDGE_CELLS.format(g=repr(float(g)) + "D", m=repr(g * 1e-9) + "D"))).alias("c"))
    return c.select("code", "s", "c.cx", "c.cy")


def boxes(areas: DataFrame) -> DataFrame:
    """(code, minx, miny, maxx, maxy) of each area."""
    v = F.flatten(F.flatten("parts"))
    x, y = F.transform(v, lambda p: p["x"]), F.transform(v, lambda p: p["y"])
    return areas.select("code", F.array_min(x).alias("minx"), F.array_min(y).alias("miny"), F.array_max(x).alias("maxx"), F.array_max(y).alias("maxy"))


def _side():
    return F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))


def _level(g: float):
    """The quadtree level (cells of side g at level 0) where a cell is as large as the box."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(_side(), F.lit(g)) / g))).cast("int")


def _at_levels(b: DataFrame, g: float) -> DataFrame:
    """``b`` with a row for each cell (L, cx, cy) that the box touches at level L; at most four."""
    size = F.lit(float(g)) * F.pow(F.lit(2.0), F.col("L"))
    lo = lambda c: F.floor(F.col(c) / size).cast("bigint")
    return b.withColumn("cx", F.explode(F.sequence(lo("minx"), lo("maxx")))).withColumn("cy", F.explode(F.sequence(lo("miny"), lo("maxy"))))


def meeting_boxes(a: DataFrame, b: DataFrame, g: float | None = None, points: bool = False) -> DataFrame:
    """(code, other, x, y) for every box of ``a`` and of ``b`` (code, minx, miny, maxx,
    maxy) that share a point.

    The larger box of a pair has at most four cells at its own level, and the
    smaller one at most four there: each box is listed at its own level and looked
    up at the coarser levels that the other table has (a level for each doubling
    of the side at most). x, y: the lower left corner of the box of ``a``. ``g``:
    the side of the smallest cells. ``points``: the boxes of ``a`` have no extent.
    """
    if g is None:
        r = a.union(b).agg(F.min(F.when(_side() > 0, _side())).alias("lo"), F.max(_side()).alias("hi")).first()
        g = max(r.lo or 1.0, (r.hi or 1.0) / 2.0 ** 40)
    a, b = a.withColumn("own", _level(g)), b.withColumn("own", _level(g))
    own = a.select(F.lit("a").alias("k"), "own").union(b.select(F.lit("b").alias("k"), "own")).distinct().collect()
    levels = {k: sorted(r.own for r in own if r.k == k) for k in ("a", "b")}
    if not levels["a"] or not levels["b"]:
        return a.select("code", F.col("code").alias("other"), F.col("minx").alias("x"), F.col("miny").alias("y")).where(F.lit(False))

    def home(x):
        return _at_levels(x.withColumn("L", F.col("own")), g)

    def visits(x, at):
        return _at_levels(x.withColumn("L", F.explode(F.filter(F.array(*[F.lit(k) for k in at]).cast("array<int>"), lambda k: k > F.col("own")))), g)

    def joined(x, y):
        x, y = x.alias("x"), y.alias("y")
        on = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("L", "cx", "cy")]
        meet = ((F.col("x.minx") <= F.col("y.maxx")) & (F.col("y.minx") <= F.col("x.maxx"))
                & (F.col("x.miny") <= F.col("y.maxy")) & (F.col("y.miny") <= F.col("x.maxy")))
        return x.join(y, on).where(meet).select(
            F.col("x.code").alias("code"), F.col("y.code").alias("other"), F.col("x.minx").alias("x"), F.col("x.miny").alias("y"))

    out = joined(home(a), home(b))
    if levels["b"][-1] > levels["a"][0]:
        out = out.union(joined(visits(a, levels["b"]), home(b)))
    if levels["a"][-1] > levels["b"][0]:
        out = out.union(joined(home(a), visits(b, levels["a"])))
    return out if points else out.distinct()  # a point lies in one cell of a level


def _orient(ax, ay, bx, by, cx, cy):
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def _segments_meet(a, b):
    """Closed segments a and b share at least one point."""
    ax1, ay1, ax2, ay2 = (F.col(f"{a}.{c}") for c in ("x1", "y1", "x2", "y2"))
    bx1, by1, bx2, by2 = (F.col(f"{b}.{c}") for c in ("x1", "y1", "x2", "y2"))
    o1 = _orient(ax1, ay1, ax2, ay2, bx1, by1)
    o2 = _orient(ax1, ay1, ax2, ay2, bx2, by2)
    o3 = _orient(bx1, by1, bx2, by2, ax1, ay1)
    o4 = _orient(bx1, by1, bx2, by2, ax2, ay2)
    box = ((F.greatest(F.least(ax1, ax2), F.least(bx1, bx2)) <= F.least(F.greatest(ax1, ax2), F.greatest(bx1, bx2)))
           & (F.greatest(F.least(ay1, ay2), F.least(by1, by2)) <= F.least(F.greatest(ay1, ay2), F.greatest(by1, by2))))
    return box & (F.signum(o1) * F.signum(o2) <= 0) & (F.signum(o3) * F.signum(o4) <= 0)


POINT_IN_POLYGON = """
aggregate(flatten(parts), 0, (acc, r) -> acc + size(filter(sequence(0, size(r) - 2), i ->
   ((r[i].y > py) != (r[i + 1].y > py))
   AND (px < (r[i + 1].x - r[i].x) * (py - r[i].y) / (r[i + 1].y - r[i].y) + r[i].x)))) % 2 = 1
"""


HOT_CELL_EDGES = 2000
MAX_SPLITS = 12


def _edge_cells(e: DataFrame, g: float, hot_limit: int, max_splits: int) -> DataFrame:
    """(code, s, L, cx, cy): each edge in every grid cell it passes through.

    A cell holding more than ``hot_limit`` edges is split into its four
    children, and its edges move to the children their box covers, until
    no cell is hot (a few rounds of small driver-side control; the data
    stays distributed). Two edges that meet share a cell at the finest
    level reached there, so the equi-join on (L, cx, cy) stays exact
    while no cell's pair count grows with a concentration of edges.
    """
    lo_x, hi_x = F.least("s.x1", "s.x2"), F.greatest("s.x1", "s.x2")
    lo_y, hi_y = F.least("s.y1", "s.y2"), F.greatest("s.y1", "s.y2")
    ec = edge_cells(e, g).select("code", "s", F.lit(0).alias("L"), "cx", "cy")
    for _ in range(max_splits):
        hot = materialize(ec.groupBy("L", "cx", "cy").count().filter(F.col("count") > hot_limit).drop("count"))
        if hot.limit(1).count() == 0:
            break
        ec, hot = materialize(ec), check_broadcastable(hot)
        inside = ec.join(hot, ["L", "cx", "cy"], "left_semi")
        rest = ec.join(hot, ["L", "cx", "cy"], "left_anti")
        gl = F.lit(g) / F.pow(F.lit(2.0), F.col("L") + 1)
        kids = (inside.select("code", "s", (F.col("L") + 1).alias("L"), "cx", "cy", gl.alias("gl"))
                .select("code", "s", "L", "cy", "gl", F.explode(F.sequence(
                    F.greatest(F.floor(lo_x / F.col("gl")).cast("bigint"), 2 * F.col("cx")),
                    F.least(F.floor(hi_x / F.col("gl")).cast("bigint"), 2 * F.col("cx") + 1))).alias("cx"))
                .select("code", "s", "L", "cx", F.explode(F.sequence(
                    F.greatest(F.floor(lo_y / F.col("gl")).cast("bigint"), 2 * F.col("cy")),
                    F.least(F.floor(hi_y / F.col("gl")).cast("bigint"), 2 * F.col("cy") + 1))).alias("cy")))
        ec = rest.unionByName(kids)
    return ec


INNER_SHARES = (1.0, 0.5, 0.25)


def inner_boxes(areas: DataFrame) -> DataFrame:
    """``areas`` with ``inner`` (minx, miny, maxx, maxy), a box that lies in the
    area, and ``full``, whether that is the area's own box.

    The largest of a few boxes around the centre of the area's box that no edge
    enters, if the centre lies inside; null if there is none, or if the code
    comes more than once.
    """
    v = F.flatten(F.flatten("parts"))
    x, y = F.transform(v, lambda p: p["x"]), F.transform(v, lambda p: p["y"])
    b = areas.select("code", "parts", F.array_min(x).alias("minx"), F.array_min(y).alias("miny"), F.array_max(x).alias("maxx"), F.array_max(y).alias("maxy"))
    b = b.withColumn("px", (F.col("minx") + F.col("maxx")) / 2.0).withColumn("py", (F.col("miny") + F.col("maxy")) / 2.0)

    def lo(axis, share):
        return f"min{axis}" if share == 1.0 else f"p{axis} - {share}D * (p{axis} - min{axis})"

    def hi(axis, share):
        return f"max{axis}" if share == 1.0 else f"p{axis} + {share}D * (max{axis} - p{axis})"

    def clear(share):
        x0, y0, x1, y1 = lo("x", share), lo("y", share), hi("x", share), hi("y", share)
        return F.expr(f"""px > {x0} AND px < {x1} AND py > {y0} AND py < {y1} AND NOT exists(flatten(parts), r -> exists(sequence(0, size(r) - 2), i ->
          greatest(r[i].x, r[i + 1].x) > {x0} AND least(r[i].x, r[i + 1].x) < {x1} AND greatest(r[i].y, r[i + 1].y) > {y0} AND least(r[i].y, r[i + 1].y) < {y1}))""")

    share = F.lit(None).cast("double")
    for k in reversed(INNER_SHARES):
        share = F.when(clear(k), F.lit(k)).otherwise(share)
    b = b.withColumn("share", F.when(~F.isnan("px") & ~F.isnan("py") & F.expr(POINT_IN_POLYGON), share))
    many = b.groupBy("code").count().where("count > 1").select("code", F.lit(True).alias("many"))
    b = b.join(many, "code", "left").withColumn("share", F.when(F.col("many").isNull(), F.col("share")))
    box = lambda k: F.expr(f"named_struct('minx', {lo('x', k)}, 'miny', {lo('y', k)}, 'maxx', {hi('x', k)}, 'maxy', {hi('y', k)})")
    inner = F.lit(None).cast("struct<minx:double,miny:double,maxx:double,maxy:double>")
    for k in INNER_SHARES:
        inner = F.when(F.col("share") == k, box(k)).otherwise(inner)
    return b.select("code", "parts", inner.alias("inner"), F.coalesce(F.col("share") == 1.0, F.lit(False)).alias("full"))


def _share_a_point(a, b):
    """Boxes a and b (column name prefixes) share a point."""
    c = lambda t, k: F.col(f"{t}.{k}")
    return ((c(a, "minx") <= c(b, "maxx")) & (c(b, "minx") <= c(a, "maxx")) & (c(a, "miny") <= c(b, "maxy")) & (c(b, "miny") <= c(a, "maxy")))


BLOCK_BOXES = 2000
TASK_TESTS = 20_000_000


def _cell_pairs(home: DataFrame, probe: DataFrame, g: float) -> DataFrame:
    """(code, nb), both directions, of the boxes of ``home`` and ``probe``
    (code, box, own, L, cx, cy) that share a point, each pair once.

    A pair counts in the one cell that holds the lower left corner of what the
    boxes share, so no pair needs to be compared with the others. A cell of many
    boxes is cut into blocks, each of one side joined with each of the other, and
    the number of tasks follows the number of comparisons.
    """
    cell, n = ["L", "cx", "cy"], F.count("*")
    met = home.groupBy(*cell).agg(n.alias("nh")).join(probe.groupBy(*cell).agg(n.alias("np")), cell)
    met = materialize(met.select(*cell, F.ceil(F.col("nh") / BLOCK_BOXES).alias("bh"), F.ceil(F.col("np") / BLOCK_BOXES).alias("bp"),
                                 (F.col("nh") * F.col("np")).cast("double").alias("tests")))
    tests = met.agg(F.sum("tests")).first()[0] or 0.0
    crowded = check_broadcastable(met.where("bh > 1 or bp > 1").drop("tests"))

    def dealt(x, own, other):
        x = x.join(crowded, cell, "left").withColumn(own, F.pmod(F.xxhash64("code"), F.coalesce(F.col(own), F.lit(1))))
        return x.withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(other), F.lit(1)) - 1)))

    h, p, on = dealt(home, "bh", "bp"), dealt(probe, "bp", "bh"), [*cell, "bh", "bp"]
    if tests > TASK_TESTS:
        tasks = min(int(tests // TASK_TESTS) + 1, 20_000)
        h, p = h.repartition(tasks, *on), p.repartition(tasks, *on)
    h, p, size = h.alias("h"), p.alias("p"), F.lit(float(g)) * F.pow(F.lit(2.0), F.col("p.L"))
    here = ((F.floor(F.greatest("h.box.minx", "p.box.minx") / size).cast("bigint") == F.col("p.cx"))
            & (F.floor(F.greatest("h.box.miny", "p.box.miny") / size).cast("bigint") == F.col("p.cy")))
    once = (F.col("p.own") < F.col("h.own")) | (F.col("p.code") < F.col("h.code"))
    j = p.join(h, [F.col(f"p.{c}") == F.col(f"h.{c}") for c in on]).where(_share_a_point("p.box", "h.box") & here & once)
    both = F.array(*[F.struct(F.col(f"{a}.code").alias("code"), F.col(f"{b}.code").alias("nb")) for a, b in ("ph", "hp")])
    return j.select(F.explode(both).alias("x")).select("x.code", "x.nb")


def _settled_pairs(known: DataFrame) -> DataFrame | None:
    """(code, nb) of the areas (code, inner, wanted) whose inner boxes share a
    point, each pair once, both directions; of two areas that are not wanted, none."""
    b = materialize(known.select("code", F.col("inner").alias("box"), "wanted", "inner.*"))
    r = b.agg(F.min(F.when(_side() > 0, _side())).alias("lo"), F.max(_side()).alias("hi")).first()
    if r.hi is None:
        return None
    g = max(r.lo or 1.0, (r.hi or 1.0) / 2.0 ** 40)
    b = b.withColumn("own", _level(g))
    levels = F.array(*[F.lit(x.own) for x in b.select("own").distinct().collect()]).cast("array<int>")  # a level for each doubling of the side

    def home(x):
        return _at_levels(x.withColumn("L", F.col("own")), g).select("code", "box", "own", "L", "cx", "cy")

    def probe(x):
        x = x.withColumn("L", F.explode(F.filter(levels, lambda k: k >= F.col("own"))))
        return _at_levels(x, g).select("code", "box", "own", "L", "cx", "cy")

    if not b.where("not wanted").limit(1).count():
        return _cell_pairs(home(b), probe(b), g)
    few, rest = b.where("wanted"), b.where("not wanted")
    # a pair is found with its smaller box (of one level: its smaller code) as the probe, so it is in one of the three
    return (_cell_pairs(home(few), probe(few), g).union(_cell_pairs(home(rest), probe(few), g))
            .union(_cell_pairs(home(few), probe(rest), g)))


def neighbour_pairs(areas: DataFrame, cell: float | None = None, hot_limit: int = HOT_CELL_EDGES, max_splits: int = MAX_SPLITS,
                    only: DataFrame | None = None) -> DataFrame:
    """(code, nb) for every pair of areas that are not disjoint, both
    directions, each area with itself included. ``only`` (code): pairs of which
    one is among these areas.

    Pairs whose inner boxes share a point need no more, and are listed once as
    they are found. The others are tested by their edges, but for pairs of areas
    that are their own boxes.
    """
    known = inner_boxes(areas)
    wanted = F.lit(True) if only is None else F.coalesce("wanted", F.lit(False))
    if only is not None:
        known = known.join(only.select("code", F.lit(True).alias("wanted")).distinct(), "code", "left")
    known = materialize(known.withColumn("wanted", wanted))
    out = known.where("wanted").select("code", F.col("code").alias("nb")).distinct()
    settled = _settled_pairs(known.where("inner is not null and code is not null").drop("parts"))
    if settled is not None:
        out = out.unionByName(settled)
    if known.where("not full").limit(1).count():
        out = out.unionByName(_edge_pairs(known, cell, hot_limit, max_splits))
    return out


def _edge_pairs(known: DataFrame, cell: float | None, hot_limit: int, max_splits: int) -> DataFrame:
    """The pairs of the areas (code, parts, inner, full, wanted) that their inner boxes don't settle."""
    e = edges(known.select(F.struct("code", "inner", "full", "wanted").alias("code"), "parts"))
    g = float(cell) if cell else default_cell(e)
    ec = materialize(_edge_cells(e, g, hot_limit, max_splits))  # made once for both sides of the join

    def unsettled(x, y):
        return (F.col(f"{x}.wanted") | F.col(f"{y}.wanted")) & ~F.coalesce(_share_a_point(f"{x}.inner", f"{y}.inner"), F.lit(False))

    a, b = ec.where("not code.full").alias("a"), ec.alias("b")
    one, other = F.col("a.code.code"), F.col("b.code.code")
    touching = (a.join(b, (F.col("a.L") == F.col("b.L")) & (F.col("a.cx") == F.col("b.cx")) & (F.col("a.cy") == F.col("b.cy"))
                       & ((F.col("b.code.full") & (one != other)) | (one < other)))
                .filter(unsettled("a.code", "b.code") & _segments_meet("a.s", "b.s"))
                .select(F.least(one, other).alias("code"), F.greatest(one, other).alias("nb")).distinct())

    # containment without edge contact: one vertex per part, a box without
    # extent, against the other area's rings
    v = known.select("code", "full", F.explode(F.expr("transform(parts, p -> p[0][0])")).alias("v"))
    points = v.select("code", F.col("v.x").alias("minx"), F.col("v.y").alias("miny"), F.col("v.x").alias("maxx"), F.col("v.y").alias("maxy"), "full")
    odd = known.where("not full")
    near = meeting_boxes(points.where("not full").drop("full"), boxes(known), g, points=True).union(
        meeting_boxes(points.where("full").drop("full"), boxes(odd), g, points=True)).where("code != other").select(
        F.col("code").alias("pcode"), F.col("other").alias("code"), F.col("x").alias("px"), F.col("y").alias("py"))
    y = known.select(F.col("code").alias("pcode"), F.struct("inner", "wanted").alias("y"))
    inside = (near.join(known.select("code", "parts", F.struct("inner", "wanted").alias("x")), "code")  # geometry only for pairs whose boxes allow it
              .filter(F.expr(POINT_IN_POLYGON)).drop("parts").join(y, "pcode").filter(unsettled("x", "y"))
              .select(F.least("code", "pcode").alias("code"), F.greatest("code", "pcode").alias("nb")))
    one_way = touching.unionByName(inside).distinct()
    return one_way.unionByName(one_way.select(F.col("nb").alias("code"), F.col("code").alias("nb")))


def boundary_digests(areas: DataFrame) -> DataFrame:
    """(code, digest, minx, miny, maxx, maxy): what the stored pairs were joined for."""
    return areas.select("code", F.sha2(F.to_json("parts"), 256).alias("digest")).join(boxes(areas), "code")


def update_pairs(areas: DataFrame, stored_areas: DataFrame, stored_pairs: DataFrame) -> DataFrame:
    """J5 kept up to date: the pairs of ``areas``, from those of an earlier set.

    ``stored_areas`` is :func:`boundary_digests` of the areas that
    ``stored_pairs`` (code, nb) hold. Areas whose digest is another, or that are
    new, are joined again with the areas whose boxes they meet; pairs of areas
    that are gone or changed go; all others stay as they are stored.
    """
    now = materialize(boundary_digests(areas))
    old = stored_areas.select("code", F.col("digest").alias("old"))
    changed = materialize(now.join(old, "code", "left").where(~F.col("digest").eqNullSafe(F.col("old"))).select("code"))
    # what is gone is sent to the stored pairs: those stay where they are read
    gone = check_broadcastable(materialize(old.join(now, "code", "left_anti").select("code").union(changed).distinct()))
    kept = stored_pairs.join(gone, "code", "left_anti").join(gone.withColumnRenamed("code", "nb"), "nb", "left_anti").select("code", "nb")
    if not changed.limit(1).count():
        return kept
    box = now.drop("digest")
    near = meeting_boxes(box.join(changed, "code", "left_semi"), box).select(F.col("other").alias("code")).distinct()
    redone = neighbour_pairs(materialize(areas.join(near, "code", "left_semi")), only=changed)
    one, other = changed.withColumn("_a", F.lit(True)), changed.select(F.col("code").alias("nb"), F.lit(True).alias("_b"))
    redone = redone.join(one, "code", "left").join(other, "nb", "left").where("_a or _b").select("code", "nb")
    return kept.union(redone)


def high_flag(value: str, threshold: float) -> F.Column:
    """Value >= threshold; a missing value is False (never NaN)."""
    v = F.col(value)
    return F.coalesce((v >= F.lit(float(threshold))) & ~F.isnan(v), F.lit(False))


def lisa(values: DataFrame, pairs: DataFrame, part_cols: list[str], value: str,
         threshold: float = 1.0) -> DataFrame:
    """A10: share of neighbours (self included) whose flag equals the
    area's own, and the neighbour count. ``values`` has part_cols, code and
    ``value`` for every area (missing values allowed)."""
    f = values.select(*part_cols, "code", high_flag(value, threshold).alias("hi"))
    j = (pairs.join(f, "code")
         .join(f.select(*part_cols, F.col("code").alias("nb"), F.col("hi").alias("nb_hi")),
               part_cols + ["nb"], "left"))
    same = (F.col("hi") == F.coalesce(F.col("nb_hi"), F.lit(False))).cast("double")
    return j.groupBy(*part_cols, "code").agg(F.avg(same).alias("LISA_score"),
                                            F.count("*").alias("LISA_support"))
