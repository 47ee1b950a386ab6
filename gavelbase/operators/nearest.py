"""Distance of the nearest point of interest of each category."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelbase.functions.clean import coordinate_key, distance_text
from gavelbase.operators.slabs import within_distance

#: Category, tags (any of them), radius in metres, words of which a named element needs one.
CATEGORIES = {
    "交通-地铁站": ((("railway", "station"), ("station", "subway"), ("subway", "yes")), 3000, ()),
    "交通-公交站": ((("highway", "bus_stop"), ("public_transport", "platform"), ("amenity", "bus_station")), 2000, ()),
    "教育-幼儿园": ((("amenity", "kindergarten"),), 3000, ()),
    "教育-小学": ((("amenity", "school"),), 3000, ("小学",)),
    "教育-中学": ((("amenity", "school"),), 4000, ("中学", "高中", "初中")),
    "购物-商场": ((("shop", "mall"), ("building", "retail"), ("landuse", "retail")), 5000, ()),
    "购物-超市": ((("shop", "supermarket"), ("shop", "convenience")), 3000, ()),
    "医疗-综合医院": ((("amenity", "hospital"),), 5000, ()),
    "医疗-诊所": ((("amenity", "clinic"), ("healthcare", "clinic")), 3000, ()),
    "公园-公园": ((("leisure", "park"), ("boundary", "protected_area")), 5000, ()),
}


def element_places(elements: DataFrame) -> DataFrame:
    """poi_id, lat, lon, tags: an element's own position, else its centre."""
    own = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return elements.select("poi_id", F.when(own, F.col("lat")).otherwise(F.col("center.lat")).alias("lat"), F.when(own, F.col("lon")).otherwise(F.col("center.lon")).alias("lon"), "tags").where("lat is not null and lon is not null")


def poi_name() -> Column:
    return F.coalesce(*(F.element_at("tags", F.lit(k)) for k in ("name:zh", "name", "name:en")))


def has_tag(key: str, value: str) -> Column:
    """A tag's value; ``yes`` is also met by true and 1."""
    have = F.element_at("tags", F.lit(key))
    return F.coalesce(have.isin("yes", "true", "1") if value == "yes" else have == value, F.lit(False))


def of_category(places: DataFrame, category: str) -> DataFrame:
    return places.where(in_category(category))


def in_category(category: str) -> Column:
    """Whether an element is of a category; one without a name passes the words' test."""
    tags, _, words = CATEGORIES[category]
    ok = reduce(lambda a, b: a | b, (has_tag(k, v) for k, v in tags))
    return ok & (poi_name().isNull() | reduce(lambda a, b: a | b, (poi_name().contains(w) for w in words))) if words else ok


def nearest(points: DataFrame, elements: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """point_id, category and the nearest distance in metres within the category's radius. points: row_id, lat, lon.

    All categories are one search: an element is a circle of each of its categories' radii.
    """
    names = categories or list(CATEGORIES)
    kinds = F.explode(F.array_compact(F.array(*(F.when(in_category(c), F.struct(F.lit(k).alias("k"), F.lit(float(CATEGORIES[c][1])).alias("m"))) for k, c in enumerate(names)))))
    places = element_places(elements).select("poi_id", "lat", "lon", kinds.alias("kind")).select(F.xxhash64("poi_id", "kind.k").alias("centre"), "lat", "lon", "kind.k", "kind.m")
    pairs = within_distance(points, places, "m", ("row_id", "lat", "lon"), ("centre", "lat", "lon"))
    kind = places.select(F.col("centre").alias("centre_id"), "k").distinct()
    best = pairs.join(kind, "centre_id").groupBy("point_id", "k").agg(F.min("distance_m").alias("distance_m"))
    return best.select("point_id", F.element_at(F.array(*map(F.lit, names)), F.col("k") + 1).alias("category"), "distance_m")


def surroundings_by_place(points: DataFrame, elements: DataFrame) -> DataFrame:
    """coord_key and a column of displayed distances for each category, blank where none is in reach: each place is searched once, however many points lie there. points: lat, lon."""
    spots = points.select("lat", "lon").where("lat is not null and lon is not null").withColumn("coord_key", coordinate_key(F.col("lat"), F.col("lon"))).groupBy("coord_key").agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"))
    spots = spots.withColumn("row_id", F.xxhash64("coord_key"))
    got = nearest(spots, elements).groupBy("point_id").pivot("category", list(CATEGORIES)).agg(F.min("distance_m"))
    shown = [F.coalesce(distance_text(F.col(f"`{c}`")), F.lit("")).alias(c) for c in CATEGORIES]
    return spots.join(got.withColumnRenamed("point_id", "row_id"), "row_id", "left").select("coord_key", *shown)
