"""Stages from pixel layers to equivalent permanence, each a function of DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geodesy
from ..operators import boxes, filters, grid, matching, outcomes, overlay, permanence, ranks, shapes, warp
from ..schema import TOLERANCES, hard_columns, stored_years
from ..session import durable

#: Fixed value: the width of the leakage zone around a project.
LEAKAGE_METRES = 5000.0
#: Fixed value: how far from a project matches are looked for.
MATCHING_METRES = 2_000_000.0


def treated_pixels(layers: dict[str, DataFrame], boundary: DataFrame, hectares: float, x0: int = 0, y0: int = 0) -> DataFrame:
    """Pixels of a lattice inside the boundary, with all layers. The lattice filters each layer before the joins. Layers whose lattices differ are
    an error, as is a boundary without a pixel of the lattice."""
    step = grid.lattice_step(hectares)
    met = grid.co_grid({k: grid.lattice_sample(v, step, x0, y0) for k, v in layers.items()}, strict=True)
    return filters.found(grid.mask(met, boundary), "the boundary holds no pixel of the lattice")


def match_table(layers: dict[str, DataFrame], marks: DataFrame) -> DataFrame:
    """Pixels that the raster of potential matches marks, with all layers. Each layer is cut to the marks before it meets the others."""
    kept = durable(filters.matched(marks).select("x", "y"), "marks")
    return grid.co_grid({k: grid.mask(v, kept) for k, v in layers.items()})


def coverage_groups(tiles: DataFrame, groups: DataFrame) -> DataFrame:
    """tiles (year, tile, ...) with their region by groups (tile, region), for coverage year by year and region by region. Each tile has to be in exactly one
    region, and each region's tiles have to be there in every year: all else is an error that names a tile."""
    once = groups.groupBy("tile").count().filter("count > 1").select("tile")
    filters.nothing(once, "a tile is in several regions")
    have = durable(tiles.select("year", "tile").distinct(), "tiles")
    filters.nothing(have.join(groups, "tile", "left_anti"), "a tile is in no region")
    wanted = have.select("year").distinct().crossJoin(groups.select("tile").distinct())  # a row a year and tile
    filters.nothing(wanted.join(have, ["year", "tile"], "left_anti"), "a region lacks a tile")
    return tiles.join(groups, "tile")


def fine_coverage(tiles: DataFrame, classes: list[int], ratio: Column | float = 1.0, radius: int = grid.FOCAL_RADIUS) -> DataFrame:
    """year, x, y and share_<class> from tiles (year, tile, x, y, value): a year's tiles are one grid, so a kernel at a tile's border sees its neighbours;
    where tiles overlap, the first by name counts."""
    one = tiles.groupBy("year", "x", "y").agg(F.min_by("value", "tile").alias("value"))
    return grid.focal_coverage(one, classes, radius, ratio, by=("year",))


def slope(elevation: DataFrame, degrees: float, north: float) -> DataFrame:
    """x, y, slope in degrees from elevations on a grid of `degrees` a cell, whose first row begins at latitude `north`. A cell's ground lengths are those
    of its own latitude, so a grid may cross zones: the fast way, without projecting."""
    east, south = geodesy.metres_per_degree(F.lit(north) - (F.col("y") + 0.5) * degrees)
    return grid.slope_horn(elevation, east * degrees, south * degrees)


def zone_slope(elevation: DataFrame, degrees: float, west: float, north: float) -> DataFrame:
    """The same by projecting each zone to metres and back, cropped and merged."""
    return warp.projected_slope(elevation, (west, north), (degrees, -degrees)).withColumnRenamed("value", "slope")


def project_shots(granules: DataFrame, boundary: DataFrame, start: str = "2020-01-01", end: str = "2021-01-01", size: float = 1.0, wanted: DataFrame | None = None) -> DataFrame:
    """Good shots of all granules (lat, lng and the flags of good_shots) that lie in any polygon of the boundary, each once. wanted: granules that a
    catalogue names, each of which has to be there (column granule): one that is missing is an error."""
    if wanted is not None:
        filters.nothing(wanted.select("granule").join(granules.select("granule").distinct(), "granule", "left_anti"), "a granule is missing")
    good = outcomes.good_shots(granules, start, end).withColumns({"x": F.col("lng"), "y": F.col("lat")})
    return shapes.points_in_polygons(good, boundary, size).drop("x", "y", "polygon_id").distinct()


def leakage_zone(pixels: DataFrame, project: DataFrame, origin: tuple[float, float], step: tuple[float, float], metres: float = LEAKAGE_METRES) -> DataFrame:
    """x, y of pixels at most so many metres from the project's polygons and in none of them."""
    return shapes.pixels_within_metres(pixels, project, metres, origin, step, outside_only=True)


def potential_matches(pixels: DataFrame, k: DataFrame, start: int, tolerances: dict[str, float] = TOLERANCES) -> DataFrame:
    """Pixels that match at least one treated one, by cells in all features."""
    return boxes.kd_semi_join(pixels, k, hard_columns(start), tolerances)


def match_all(k: DataFrame, m: DataFrame, start: int, end: int, master_seed: int, repetitions: int = matching.REPETITIONS, tolerances: dict[str, float] = TOLERANCES, share: float = matching.SAMPLE_SHARE, required: int = matching.REQUIRED) -> tuple[DataFrame, DataFrame]:
    """(wide pairs with iteration, status) of all repetitions at once: in each a sample of k, up to `required` candidates for each row, and greedy
    pairs. A repetition is a column and part of each key, so the plan is the same for one and for a hundred, and their groups run side by side.
    """
    hard, features = hard_columns(start), list(tolerances)
    m = durable(ranks.with_position(m, ["y", "x"]), "positions")
    drawn = matching.samples(k, share, durable(matching.seeds(k.sparkSession, master_seed, repetitions), "seeds", 1))
    drawn = durable(drawn.withColumn("one", F.struct("iteration", "id")), "samples")
    found = matching.candidate_pairs(drawn.drop("id").withColumnRenamed("one", "id"), m, hard, tolerances, required=required, by="elevation", start=F.xxhash64(F.col("seed").cast("int"), F.col("id.id")))
    found = durable(found.select("k_id.iteration", F.col("k_id.id").alias("k_id"), "m_id"), "candidates")
    wanted = found.select("iteration", F.col("m_id").alias("id")).distinct()
    s = durable(matching.scaled(wanted.join(m, "id").select("iteration", "id", *hard, *features), tolerances), "candidate-sets")
    able = drawn.join(found.select("iteration", F.col("k_id").alias("id")).distinct(), ["iteration", "id"], "left_semi")
    pairs = matching.greedy_pairs(matching.scaled(able, tolerances), s, hard, features, matching.inverse_covariances(s, features, "iteration"), by="iteration")
    pairs = durable(pairs, "pairs")
    columns = ["lat", "lng", *(f"luc_{y}" for y in stored_years(start, end)), *tolerances]
    return matching.wide_pairs(pairs, k, m, columns, by=("iteration",)), matching.pair_status(drawn, pairs, found, by=("iteration",))


def project_additionality(pairs: DataFrame, area_m2: float, density: list[float], end: int, repetitions: int) -> DataFrame:
    """year, treatment, control, additionality; over a leakage zone's pairs it is the leakage."""
    classes = outcomes.long_classes(outcomes.assert_iterations(pairs, repetitions))
    stocks = outcomes.carbon_stock(outcomes.class_shares(outcomes.class_counts(classes)), area_m2, density)
    return outcomes.additionality(stocks, end=end)


def project_permanence(additionality: DataFrame, leakage: DataFrame, cost: DataFrame, current: int, quality: str = "high", project_end: int = 2042, horizon: int = permanence.HORIZON) -> DataFrame:
    """Equivalent permanence of the current year."""
    first = additionality.agg(F.min("year")).first()[0]
    net = permanence.net_sequestration(additionality, leakage)
    schedule = permanence.release_schedule(net, quality, first, current, project_end, horizon)
    adjusted = permanence.adjusted_net(net, schedule).filter(F.col("year") == current)
    return permanence.equivalent_permanence(adjusted, schedule.filter(F.col("est_year") == current), cost, horizon)


def other_surroundings(area: DataFrame, others: DataFrame, metres: float = LEAKAGE_METRES, size: float = 1.0) -> DataFrame:
    """Surroundings of the other projects whose simple outline, widened, meets the area: a project's boundary may be long, so its convex hull is tried
    first. polygons of others have a project_id."""
    corners = others.select("project_id", F.explode("ring").alias("p")).groupBy("project_id").agg(shapes.convex_hull(F.collect_list("p")).alias("ring"))
    hulls = shapes.buffer_parts(corners.withColumnRenamed("project_id", "polygon_id"), metres)
    near = shapes.spatial_join(hulls.select("polygon_id", "ring"), area, size).select(F.col("a_id").alias("project_id")).distinct()
    return overlay.buffer(others.join(near, "project_id", "left_semi"), metres)


def matching_area(project: DataFrame, countries: DataFrame, ecoregions: DataFrame, others: DataFrame, radius: float = MATCHING_METRES, metres: float = LEAKAGE_METRES, size: float = 1.0) -> DataFrame:
    """polygon_id, ring, holes: what lies within the radius of the project, in the countries and in the ecoregions that the project meets, without the
    project's and other projects' surroundings. No ecoregion that meets the project is an error."""
    area = overlay.intersection(overlay.buffer(project, radius), countries, size)
    area = durable(overlay.intersection(area, shapes.meeting(ecoregions, project, size), size), "matching-area")
    area = durable(overlay.difference(area, overlay.buffer(project, metres), size), "matching-area")
    return overlay.difference(area, other_surroundings(area, others, metres, size), size)


def matching_pixels(pixels: DataFrame, project: DataFrame, countries: DataFrame, ecoregions: DataFrame, others: DataFrame, origin: tuple[float, float], step: tuple[float, float], radius: float = MATCHING_METRES, metres: float = LEAKAGE_METRES, size: float = 1.0) -> DataFrame:
    """x, y of the pixels whose centres lie in matching_area(), by the distance of each centre instead of by shapes: for a raster."""
    near = lambda rows, shape, m: shapes.pixels_within_metres(rows, shape, m, origin, step, size)
    inside = lambda rows, shape: shapes.points_in_polygons(shapes.pixel_centres(rows, origin, step), shape.select("polygon_id", "ring", *shapes.holes_of(shape)), size).select(F.col("px").alias("x"), F.col("py").alias("y")).distinct()
    area = inside(inside(near(pixels, project, radius), countries), shapes.meeting(ecoregions, project, size))
    area = durable(grid.without(area, near(area, project, metres)), "matching-pixels")
    return grid.without(area, near(area, others, metres))
