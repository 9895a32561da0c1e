"""Match every site to its nearest schedule location."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from wattline.functions import chord2, haversine_metres, unit_vector
from wattline.functions.geo import EARTH_RADIUS_METRES
from wattline.sources.scratch import written

MAX_INLINE_LOCATIONS = 2_000
FINEST_LEVEL = 22  # cells of about 1.5 m
BROADCAST_LEVEL = 5  # the unit sphere touches fewer than 50,000 cells of this level


def schedule_locations(schedule: DataFrame) -> DataFrame:
    """Distinct locations of a staged schedule; the point is a function of the text."""
    return (
        schedule.where(F.col("original_coordinate").isNotNull())
        .groupBy("original_coordinate")
        .agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"))
    )


def nearest_location(
    sites: DataFrame,
    schedule: DataFrame,
    *,
    radius: float = EARTH_RADIUS_METRES,
    max_inline_locations: int = MAX_INLINE_LOCATIONS,
) -> DataFrame:
    """One row per meter: its nearest location (ties by coordinate text) and the distance.

    A site without a point takes the first location by text, with a null distance; among several
    sites with one id that one comes first. No site/location pairs are produced: a checked small
    number of locations rides along as one array value (a scalar subquery) and each site picks
    from it in place; a larger number is searched through nested cells.
    """
    locations = schedule_locations(schedule)
    if locations.count() <= max_inline_locations:
        matched = _pick_inline(sites, locations)
    else:
        matched = _pick_by_cells(sites, written(locations, "locations"))
    best = F.min(
        F.struct(
            "near.d2",
            "near.original_coordinate",
            "multiplication_factor",
            "region",
            "province",
            "lat",
            "lon",
            F.col("near.lat").alias("near_lat"),
            F.col("near.lon").alias("near_lon"),
        )
    ).alias("b")
    distance = haversine_metres(F.col("b.lat"), F.col("b.lon"), F.col("b.near_lat"), F.col("b.near_lon"), radius)
    return (
        matched.groupBy("meter_id")
        .agg(best)
        .select(
            "meter_id",
            "b.multiplication_factor",
            F.col("b.lat").alias("meter_lat"),
            F.col("b.lon").alias("meter_lon"),
            "b.region",
            "b.province",
            F.col("b.original_coordinate").alias("nearest_prayer_coordinate"),
            distance.alias("distance_meters"),
            F.lit(1).cast("bigint").alias("rn"),
        )
    )


def _vector(prefix: str = "") -> tuple[Column, Column, Column]:
    return F.col(prefix + "x"), F.col(prefix + "y"), F.col(prefix + "z")


def _with_vector(df: DataFrame) -> DataFrame:
    x, y, z = unit_vector(F.col("lat"), F.col("lon"))
    return df.withColumns({"x": x, "y": y, "z": z})


def _pick_inline(sites: DataFrame, locations: DataFrame) -> DataFrame:
    packed = _with_vector(locations).agg(F.array_agg(F.struct("x", "y", "z", "original_coordinate", "lat", "lon")))

    def candidate(p: Column) -> Column:
        d2 = chord2(_vector(), (p["x"], p["y"], p["z"]))
        return F.struct(
            d2.alias("d2"),
            p["original_coordinate"].alias("original_coordinate"),
            p["lat"].alias("lat"),
            p["lon"].alias("lon"),
        )

    # the search is work per row, not per byte, so spread the rows over all cores
    spread = sites.repartition(sites.sparkSession.sparkContext.defaultParallelism)
    options = _with_vector(spread).withColumn("options", packed.scalar()).where(F.size("options") > 0)
    # nulls sort first inside a struct, which is the order wanted for sites without a point
    return options.withColumn("near", F.array_min(F.transform("options", candidate))).drop("options")


def _cell(level: int, v: tuple[Column, Column, Column]) -> Column:
    """Cube of edge 2^-level holding a point, as one struct."""
    edge = float(2**level)
    return F.struct(*[F.floor(c * edge).alias(n) for c, n in zip(v, "ijk")])


def _pick_by_cells(sites: DataFrame, locations: DataFrame) -> DataFrame:
    """Exact search from coarse to fine cells.

    Each point keeps only the cells that can still hold its nearest location: those whose closest
    corner is no farther than the closest known location of any kept cell. Cells are narrowed by
    an equi-join on the parent cell, so a crowded cell is never expanded into all its members at
    once, and the work per point stays near the number of levels.
    """
    # one text per point, nearest text first
    members = written(
        _with_vector(locations.groupBy("lat", "lon").agg(F.min("original_coordinate").alias("original_coordinate"))),
        "members",
    )
    leaf = _leaf_level(members)
    points = sites.where("lat is not null").select("lat", "lon").distinct()
    kept = _with_vector(points).withColumn("cell", F.lit(0))
    parent_level: int | None = None
    for level in [*range(1, leaf, 2), leaf]:
        parent = F.lit(0) if parent_level is None else _cell(parent_level, _vector())
        cells = (
            members.groupBy(_cell(level, _vector()).alias("child"), parent.alias("cell"))
            .agg(
                *[F.min(c).alias(f"lo_{c}") for c in "xyz"],
                *[F.max(c).alias(f"hi_{c}") for c in "xyz"],
                F.min(F.struct("x", "y", "z")).alias("one"),
            )
        )
        gap = [F.greatest(F.col(f"lo_{c}") - F.col(c), F.col(c) - F.col(f"hi_{c}"), F.lit(0.0)) for c in "xyz"]
        nearest_corner = gap[0] * gap[0] + gap[1] * gap[1] + gap[2] * gap[2]
        known = chord2(_vector(), (F.col("one.x"), F.col("one.y"), F.col("one.z")))
        bound = F.min("known").over(W.partitionBy("lat", "lon"))
        kept = written(
            kept.join(F.broadcast(cells) if level <= BROADCAST_LEVEL else cells, "cell")
            .select("lat", "lon", "x", "y", "z", "child", nearest_corner.alias("gap"), known.alias("known"))
            .withColumn("bound", bound)
            # slack for floating point; extra cells only cost work
            .where("gap <= bound * (1 + 1e-9) + 1e-24")
            .select("lat", "lon", "x", "y", "z", F.col("child").alias("cell")),
            f"cells-{level}",
        )
        parent_level = level
    targets = members.select(
        _cell(leaf, _vector()).alias("cell"),
        *[F.col(c).alias(f"to_{c}") for c in ("x", "y", "z", "lat", "lon")],
        "original_coordinate",
    )
    d2 = chord2(_vector(), _vector("to_"))
    nearest = (
        kept.join(targets, "cell")
        .groupBy("lat", "lon")
        .agg(
            F.min(
                F.struct(
                    d2.alias("d2"), "original_coordinate", F.col("to_lat").alias("lat"), F.col("to_lon").alias("lon")
                )
            ).alias("near")
        )
    )
    first = locations.agg(
        F.min(F.struct(F.lit(None).cast("double").alias("d2"), "original_coordinate", "lat", "lon")).alias("near")
    )
    located = sites.where("lat is not null").join(nearest, ["lat", "lon"])
    unlocated = sites.where("lat is null").withColumn("near", first.scalar()).where("near is not null")
    return located.unionByName(unlocated)


def _leaf_level(members: DataFrame) -> int:
    """Coarsest level at which no cell holds two locations (or the finest level there is)."""
    levels = range(1, FINEST_LEVEL + 1)
    per_level = F.explode(F.array(*[F.struct(F.lit(n).alias("level"), _cell(n, _vector()).alias("cell")) for n in levels]))
    crowded = (
        members.select(per_level.alias("c"))
        .groupBy("c")
        .count()
        .where("count > 1")
        .agg(F.max("c.level").alias("level"))
        .first()["level"]
    )
    return min((crowded or 0) + 1, FINEST_LEVEL)
