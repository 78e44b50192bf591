"""Points and polygons with built-in array functions.

A polygon is a row ``polygon_id, state, district, rings`` where ``rings`` is
``array<array<array<double>>>`` (lng, lat) holding all rings of all parts; holes follow
from the even-odd rule.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldcast.session import checkpoint

EARTH_RADIUS = 6378137.0
#: Edges that a cell may meet before it is cut into four, and the most cuts.
CELL_EDGES, CELL_LEVELS = 256, 16
#: The most halvings of the extent in the search for nearest polygons.
NEAREST_LEVELS = 20


def with_edges(polys: DataFrame) -> DataFrame:
    """Replace rings by their edges and add the bounding box."""
    def ring_edges(ring: Column) -> Column:
        heads = F.slice(ring, 1, F.size(ring) - 1)
        tails = F.slice(ring, 2, F.size(ring) - 1)
        return F.zip_with(heads, tails, lambda a, b: F.struct(
            a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")))

    edges = F.flatten(F.transform("rings", ring_edges))

    def bound(f, field):
        return f(F.transform("edges", lambda e: e[field]))

    return polys.withColumn("edges", edges).withColumns({
        "min_x": bound(F.array_min, "x1"), "max_x": bound(F.array_max, "x1"),
        "min_y": bound(F.array_min, "y1"), "max_y": bound(F.array_max, "y1")}).drop("rings")


def intersects(x: Column, y: Column, edges: Column, passed: Column | None = None) -> Column:
    """Odd number of crossings (``passed``: others besides these edges), or on the border."""
    def crossing(n: Column, e: Column) -> Column:
        at = (e["x2"] - e["x1"]) * F.try_divide(y - e["y1"], e["y2"] - e["y1"]) + e["x1"]
        hit = ((e["y1"] > y) != (e["y2"] > y)) & F.coalesce(x < at, F.lit(False))
        return n + hit.cast("int")

    def on_edge(e: Column) -> Column:
        cross = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
        return ((cross == 0) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
                & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))

    start = F.lit(0) if passed is None else passed
    return (F.aggregate(edges, start, crossing) % 2 == 1) | F.exists(edges, on_edge)


def _cells(lo: Column, hi: Column, size: float) -> Column:
    return F.explode(F.sequence(F.floor(lo / size), F.floor(hi / size)))


def _toggles(size: float) -> Column:
    """Heights at which an edge right of a cell changes the crossings of points in the cell.

    The edge is crossed from its lower end (below the cell: from the cell's bottom) to below its
    upper end.
    """
    bottom = F.col("cy") * F.lit(size)
    low, high = F.least("e.y1", "e.y2"), F.greatest("e.y1", "e.y2")
    crossed = (low < high) & (high > bottom) & (low < bottom + size)
    both = F.array(F.greatest(low, bottom), high)
    return F.when(crossed, F.filter(both, lambda y: y < bottom + size))


def _odd(toggles: DataFrame) -> DataFrame:
    """Heights met an odd number of times; the others cancel, as at vertices of one chain."""
    return toggles.groupBy("cx", "cy", "polygon_id", "y").agg(
        F.count(F.lit(1)).alias("n")).where("n % 2 = 1").drop("n")


def cell_index(polys: DataFrame, cell: float = 1.0, most_edges: int = CELL_EDGES,
               levels: int = CELL_LEVELS) -> tuple[DataFrame, list[DataFrame]]:
    """Adaptive grid of polygons: the leaf cells, and the cells split at each level.

    A leaf (level, cx, cy) lists its polygons with ``edges``, those whose box meets the cell, and
    ``toggles``, heights at which the number of edges entirely right of the cell changes between
    even and odd.  Both together tell for every point of the cell what all edges of the polygon
    tell.  A cell that meets more than ``most_edges`` edges is cut into four, so the bytes of a
    cell do not grow with the polygons that reach into it.  Edges are rows all along: no task
    holds a polygon as a whole.
    """
    edged = with_edges(polys)
    names = edged.select("polygon_id", "state", "district")
    edges = checkpoint(edged.select("polygon_id", "min_x", F.explode("edges").alias("e")))
    margin = cell * 1e-6
    left, right = F.least("e.x1", "e.x2"), F.greatest("e.x1", "e.x2")
    low, high = F.least("e.y1", "e.y2"), F.greatest("e.y1", "e.y2")
    near = edges.withColumn("cx", _cells(left - margin, right + margin, cell)).withColumn(
        "cy", _cells(low - margin, high + margin, cell)).select("cx", "cy", "polygon_id", "e")
    # cells of the row entirely left of the edge, back to the polygon's first column
    first = F.floor((F.col("min_x") - margin) / cell)  # as far left as any near edge
    last = F.floor((left - margin) / cell) - 1
    far = edges.where((low < high) & (last >= first)).withColumn(
        "cx", F.explode(F.sequence(first, last))).withColumn("cy", _cells(low, high, cell))
    toggles = _odd(far.select("cx", "cy", "polygon_id", F.explode(_toggles(cell)).alias("y")))
    leaves, splits, size = None, [], cell
    for level in range(levels + 1):
        near, toggles = checkpoint(near), checkpoint(toggles)
        full = near.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n")).where(
            F.col("n") > most_edges).drop("n")
        full = checkpoint(full if level < levels else full.limit(0))
        stay = lambda df: df.join(full, ["cx", "cy"], "left_anti")
        listed = stay(near).groupBy("cx", "cy", "polygon_id").agg(
            F.collect_list("e").alias("edges")).join(
            stay(toggles).groupBy("cx", "cy", "polygon_id").agg(
                F.collect_list("y").alias("toggles")), ["cx", "cy", "polygon_id"], "full")
        leaf = listed.join(names, "polygon_id").groupBy("cx", "cy").agg(F.array_sort(
            F.collect_list(F.struct(
                "polygon_id", "state", "district",
                F.coalesce("edges", F.expr("array()").cast(listed.schema["edges"].dataType))
                .alias("edges"),
                F.coalesce("toggles", F.expr("array()").cast("array<double>"))
                .alias("toggles")))).alias("_polys")).withColumn("level", F.lit(level))
        leaf = checkpoint(leaf)
        leaves = leaf if leaves is None else leaves.unionByName(leaf)
        if full.isEmpty():
            break
        splits.append(full)
        size /= 2
        quarter = F.explode(F.array(*[F.struct((F.col("cx") * 2 + i).alias("cx"),
                                               (F.col("cy") * 2 + j).alias("cy"))
                                      for i in (0, 1) for j in (0, 1)]))
        inner = near.join(full, ["cx", "cy"]).withColumn("q", quarter).select(
            "q.cx", "q.cy", "polygon_id", "e")
        x0, y0 = F.col("cx") * F.lit(size), F.col("cy") * F.lit(size)
        beyond = left - margin >= x0 + size
        meets = ~beyond & (right + margin >= x0) & (low - margin < y0 + size) & (
            high + margin >= y0)
        passed = toggles.join(full, ["cx", "cy"]).withColumn("q", quarter).select(
            "q.cx", "q.cy", "polygon_id", "y")
        passed = passed.where(F.col("y") < y0 + size).withColumn("y", F.greatest("y", y0))
        toggles = _odd(passed.unionByName(inner.where(beyond).select(
            "cx", "cy", "polygon_id", F.explode(_toggles(size)).alias("y"))))
        near = inner.where(meets)
    return leaves, splits


def spatial_join(points: DataFrame, polys: DataFrame, cell: float = 1.0, lng: str = "lng",
                 lat: str = "lat", most_edges: int = CELL_EDGES) -> DataFrame:
    """State and district of the first polygon (by id) that holds each point (NULL if none).

    Points meet one leaf cell of :func:`cell_index` by equality: first their level is looked up
    in the cells split, then the leaf is joined, so there is no cross join and no fan-out.
    """
    leaves, splits = cell_index(polys, cell, most_edges)
    x, y = F.col(lng), F.col(lat)
    located = points.withColumns({"_cx": F.floor(x / cell), "_cy": F.floor(y / cell),
                                  "_level": F.lit(0)})
    size = cell
    for level, split in enumerate(splits):
        size /= 2
        cut = split.select(F.col("cx").alias("_sx"), F.col("cy").alias("_sy"),
                           F.lit(True).alias("_cut"))
        deeper = F.col("_cut").isNotNull()
        located = located.join(cut, (F.col("_cx") == F.col("_sx")) & (F.col("_cy") == F.col("_sy"))
                               & (F.col("_level") == level), "left").withColumns({
            "_cx": F.when(deeper, F.floor(x / size)).otherwise(F.col("_cx")),
            "_cy": F.when(deeper, F.floor(y / size)).otherwise(F.col("_cy")),
            "_level": F.when(deeper, level + 1).otherwise(F.col("_level"))}).drop(
            "_sx", "_sy", "_cut")
    joined = located.join(leaves.select(F.col("level").alias("_level"), F.col("cx").alias("_cx"),
                                        F.col("cy").alias("_cy"), "_polys"),
                          ["_level", "_cx", "_cy"], "left")

    def holds(p: Column) -> Column:
        passed = F.size(F.filter(p["toggles"], lambda t: t <= y))
        return intersects(x, y, p["edges"], passed)

    hit = F.get(F.filter("_polys", holds), 0)
    return joined.withColumn("_hit", hit).withColumns({
        "polygon_id": F.col("_hit.polygon_id"), "state": F.col("_hit.state"),
        "district": F.col("_hit.district")}).drop("_level", "_cx", "_cy", "_polys", "_hit")


def mercator(lng: Column, lat: Column) -> tuple[Column, Column]:
    """Web Mercator metres."""
    return (F.lit(EARTH_RADIUS) * F.radians(lng),
            F.lit(EARTH_RADIUS) * F.log(F.tan(F.pi() / 4 + F.radians(lat) / 2)))


def segment_distance(x: Column, y: Column, e: Column) -> Column:
    """Distance of a point to a segment; a zero-length segment is its end point."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    along = F.coalesce(F.try_divide((x - e["x1"]) * dx + (y - e["y1"]) * dy,
                                    dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    return F.hypot(x - e["x1"] - t * dx, y - e["y1"] - t * dy)


def _box_bounds(size: float, x0: float, y0: float) -> tuple[Column, Column]:
    """Least and greatest distance of a point (_px, _py) to the places of cell (cx, cy)."""
    def sides(p: Column, c: Column, origin: float) -> tuple[Column, Column]:
        low = F.lit(origin) + c * F.lit(size) - p
        high = low + size
        return (F.greatest(F.lit(0.0), low, -high), F.greatest(F.abs(low), F.abs(high)))

    (near_x, far_x), (near_y, far_y) = (sides(F.col("_px"), F.col("cx"), x0),
                                        sides(F.col("_py"), F.col("cy"), y0))
    return F.hypot(near_x, near_y), F.hypot(far_x, far_y)


def _edge_cells(edges: DataFrame) -> tuple[DataFrame, float, float, float, int]:
    """Edges by the grid cells near them: the rows, cell size, origin and height of the grid.

    Long edges are cut into steps of a cell, so they name few cells that they do not meet.  The
    cell is the median edge, but large enough for five steps an edge on average and for
    `NEAREST_LEVELS` halvings of the whole extent.  ``held`` marks cells that surely hold a place
    of the edge.
    """
    length = F.hypot(F.col("e.x2") - F.col("e.x1"), F.col("e.y2") - F.col("e.y1"))
    found = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(length).alias("sum"),
        F.approx_percentile(length, 0.5).alias("mid"),
        F.min(F.least("e.x1", "e.x2")).alias("x0"), F.min(F.least("e.y1", "e.y2")).alias("y0"),
        F.max(F.greatest("e.x1", "e.x2")).alias("x1"),
        F.max(F.greatest("e.y1", "e.y2")).alias("y1")).first()
    x0, y0 = found["x0"] or 0.0, found["y0"] or 0.0
    extent = max((found["x1"] or 0.0) - x0, (found["y1"] or 0.0) - y0, 1.0)
    size = max(found["mid"] or 0.0, (found["sum"] or 0.0) / (4 * max(found["n"], 1)),
               extent / (1 << NEAREST_LEVELS))
    height = max(0, math.ceil(math.log2(extent / size + 1)))
    steps = F.greatest(F.lit(1), F.ceil(length / size))
    cut = edges.withColumn("_n", steps).withColumn(
        "_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))

    def place(field: str, step: Column, origin: float) -> Column:
        return F.col(f"e.{field}1") + (F.col(f"e.{field}2") - F.col(f"e.{field}1")) * (
            step / F.col("_n")) - origin

    def cell(at: Column) -> Column:
        return F.greatest(F.lit(0).cast("long"), F.floor(at / size))

    def span(field: str, origin: float) -> Column:
        ends = [place(field, F.col("_i") + i, origin) for i in (0, 1)]
        return F.explode(F.sequence(cell(F.least(*ends)), cell(F.greatest(*ends))))

    rows = cut.withColumns({"_hx": cell(place("x", F.col("_i"), x0)),
                            "_hy": cell(place("y", F.col("_i"), y0))})
    rows = rows.withColumn("cx", span("x", x0)).withColumn("cy", span("y", y0))
    held = (F.col("cx") == F.col("_hx")) & (F.col("cy") == F.col("_hy"))
    return (rows.groupBy("cx", "cy", "polygon_id", "e").agg(F.max(held).alias("held")),
            size, x0, y0, height)


def nearest_polygon(points: DataFrame, polys: DataFrame, lng: str = "lng", lat: str = "lat"
                    ) -> DataFrame:
    """Nearest polygon of each point, distances in Web Mercator; none without coordinates.

    Best-first search down a grid of edges, two levels a round, for all places at once.  A place
    keeps the cells whose least distance is not over the greatest distance of some cell known to
    hold a part of an edge, and compares edges in the last cells only.  Cells meet by equality,
    no point scans all polygons, and no task holds a polygon.  Equal distances go to the smaller
    id; points in the same place are searched once.
    """
    def project(e: Column) -> Column:
        x1, y1 = mercator(e["x1"], e["y1"])
        x2, y2 = mercator(e["x2"], e["y2"])
        return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))

    px, py = mercator(F.col(lng), F.col(lat))
    edged = with_edges(polys)
    names = edged.select("polygon_id", "state", "district")
    edges = checkpoint(edged.select("polygon_id", F.explode(
        F.transform("edges", project)).alias("e")).filter(
        "e.x1 + e.y1 + e.x2 + e.y2 IS NOT NULL"))
    rows, size, x0, y0, height = _edge_cells(edges)
    rows = checkpoint(rows)
    leaves = checkpoint(rows.groupBy("cx", "cy").agg(F.max("held").alias("held")))
    spots = points.select(F.col(lng).alias("_lng"), F.col(lat).alias("_lat"), px.alias("_px"),
                          py.alias("_py")).filter(
        "_px IS NOT NULL AND _py IS NOT NULL AND NOT isnan(_px) AND NOT isnan(_py)").distinct()
    spot = ["_lng", "_lat", "_px", "_py"]
    near = checkpoint(spots).withColumns({"cx": F.lit(0).cast("long"), "cy": F.lit(0).cast("long")})
    level = height
    while level > 0:
        down = min(2, level)
        level -= down
        width = float(size * (1 << level))
        part = F.sequence(F.lit(0).cast("long"), F.lit((1 << down) - 1).cast("long"))
        near = near.withColumn("_i", F.explode(part)).withColumn("_j", F.explode(part)).withColumns({
            "cx": F.col("cx") * (1 << down) + F.col("_i"),
            "cy": F.col("cy") * (1 << down) + F.col("_j")}).drop("_i", "_j")
        cells = leaves.groupBy(F.shiftright("cx", level).alias("cx"),
                               F.shiftright("cy", level).alias("cy")).agg(
            F.max("held").alias("held"))
        least, greatest = _box_bounds(width, x0, y0)
        bound = F.min(F.when(F.col("held"), greatest)).over(Window.partitionBy(*spot))
        near = checkpoint(near.join(cells, ["cx", "cy"]).withColumns({
            "_least": least, "_bound": bound}).filter(  # a millimetre for rounding
            F.col("_least") <= F.col("_bound") * (1 + 1e-9) + 1e-3).select(*spot, "cx", "cy"))
    distance = segment_distance(F.col("_px"), F.col("_py"), F.col("e"))
    best = near.join(rows, ["cx", "cy"]).groupBy("_lng", "_lat").agg(
        F.min(F.struct(distance.alias("distance"), "polygon_id")).alias("_best"))
    found = best.select("_lng", "_lat", "_best.polygon_id", "_best.distance").join(
        names, "polygon_id")
    out = points.drop("polygon_id", "state", "district", "distance")
    return out.join(found, (F.col(lng) == F.col("_lng")) & (F.col(lat) == F.col("_lat")),
                    "left").select(*out.columns, "polygon_id", "state", "district", "distance")


def enrich_points(points: DataFrame, polys: DataFrame, cell: float = 1.0) -> DataFrame:
    """Holding polygon of each point, else the nearest one; points meet the grid once."""
    joined = checkpoint(spatial_join(points, polys, cell))
    inside = joined.filter("polygon_id IS NOT NULL")
    outside = joined.filter("polygon_id IS NULL").select(*points.columns)
    return inside.unionByName(nearest_polygon(outside, polys).drop("distance"))
