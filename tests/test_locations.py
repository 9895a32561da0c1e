import math
import random

import pytest

from wattline.operators.joins import join_per_key
from wattline.operators.nearest import nearest_location
from wattline.functions.geo import EARTH_RADIUS_METRES
from pyspark.sql import functions as F

SITES = "meter_id string, multiplication_factor double, lat double, lon double, region string, province string"
PLACES = "original_coordinate string, lat double, lon double"


def metres(a, b):
    la, lo, lb, lp = (math.radians(v) for v in (*a, *b))
    root = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * EARTH_RADIUS_METRES * math.asin(min(1, math.sqrt(root)))


@pytest.fixture(scope="module")
def world():
    """Sites over the whole globe; locations spread out, crowded in one spot, at poles and the date line."""
    dice = random.Random(3)
    places = [(dice.uniform(-90, 90), dice.uniform(-180, 180)) for _ in range(60)]
    places += [(24.7 + dice.uniform(-1e-3, 1e-3), 46.7 + dice.uniform(-1e-3, 1e-3)) for _ in range(120)]
    places += [(90.0, 0.0), (-90.0, 0.0), (0.0, 180.0), (0.0, -179.9)]
    sites = [(dice.uniform(-90, 90), dice.uniform(-180, 180)) for _ in range(150)]
    sites += [(24.7 + dice.uniform(-0.3, 0.3), 46.7 + dice.uniform(-0.3, 0.3)) for _ in range(100)]
    sites += [(89.9, 170.0), (-89.9, 5.0), (0.01, 179.99), (0.0, -180.0), (24.7, 46.7)]
    return sites, places


@pytest.mark.parametrize("inline", [0, 2000])
def test_equals_brute_force(spark, world, inline):
    sites, places = world
    site_rows = [(str(i), 1.0, a, b, "r", "p") for i, (a, b) in enumerate(sites)]
    place_rows = [(f"({a}, {b})", a, b) for a, b in places]
    got = nearest_location(
        spark.createDataFrame(site_rows, SITES), spark.createDataFrame(place_rows, PLACES), max_inline_locations=inline
    ).collect()
    assert len(got) == len(sites) and {r.rn for r in got} == {1}
    for row in got:
        best = min(metres(sites[int(row.meter_id)], p) for p in places)
        assert row.distance_meters == pytest.approx(best, abs=1e-3)


@pytest.mark.parametrize("inline", [0, 2000])
def test_ties_nulls_and_repeated_ids(spark, inline):
    sites = [
        ("tie", 1.0, 0.0, 0.0, "r", "p"),
        ("nowhere", 1.0, None, None, "r", "p"),
        ("twice", 2.0, 0.0, 1.0, "far", "p"),
        ("twice", 3.0, 0.0, 10.0, "near", "p"),
        ("half", 2.0, 0.0, 9.9, "located", "p"),
        ("half", 3.0, None, None, "not", "p"),
    ]
    places = [("b", 0.0, 10.0), ("a", 0.0, -10.0), ("b", 0.0, 10.0), (None, None, None)]
    got = {
        r.meter_id: r
        for r in nearest_location(
            spark.createDataFrame(sites, SITES), spark.createDataFrame(places, PLACES), max_inline_locations=inline
        ).collect()
    }
    assert got["tie"].nearest_prayer_coordinate == "a"
    assert (got["nowhere"].nearest_prayer_coordinate, got["nowhere"].distance_meters) == ("a", None)
    assert (got["twice"].region, got["twice"].distance_meters) == ("near", 0.0)
    assert (got["half"].region, got["half"].distance_meters) == ("not", None)


@pytest.mark.parametrize("inline", [0, 2000])
def test_no_locations_no_rows(spark, inline):
    sites = spark.createDataFrame([("a", 1.0, 0.0, 0.0, "r", "p")], SITES)
    assert nearest_location(sites, spark.createDataFrame([], PLACES), max_inline_locations=inline).count() == 0


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast_join(spark, how):
    facts = spark.range(2000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = facts.where("id % 2 = 0").select("k").distinct().withColumn("v", F.length("k"))
    small = join_per_key(facts, right, ["k"], how, F.col("id"))
    large = join_per_key(facts, right, ["k"], how, F.col("id"), max_broadcast_bytes=0)
    assert small.columns == large.columns
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, large.collect()), key=str)
