"""Tag predicates and transformations, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keys whose tags make a closed way an area, and the values of each that do not.
AREA_KEYS: dict[str, tuple[str, ...]] = {
    "addr:*": (),
    "advertising": ("billboard",),
    "aerialway": ("cable_car", "chair_lift", "drag_lift", "gondola", "goods", "magic_carpet", "mixed_lift", "platter", "rope_tow", "t-bar"),
    "aeroway": ("runway", "taxiway"),
    "allotments": (),
    "amenity": ("bench",),
    "area:highway": (),
    "attraction": ("dark_ride", "river_rafting", "train", "water_slide"),
    "building": (),
    "camp_site": (),
    "club": (),
    "craft": (),
    "emergency": ("designated", "destination", "no", "official", "private", "yes"),
    "golf": ("hole", "lateral_water_hazard", "water_hazard"),
    "healthcare": (),
    "historic": (),
    "industrial": (),
    "junction": ("circular", "roundabout"),
    "landuse": (),
    "leisure": ("slipway", "track"),
    "man_made": ("breakwater", "crane", "cutline", "embankment", "groyne", "pier", "pipeline"),
    "military": (),
    "natural": ("cliff", "coastline", "ridge", "tree_row"),
    "office": (),
    "piste:type": (),
    "place": (),
    "playground": ("balancebeam", "slide", "zipwire"),
    "power": ("line", "minor_line"),
    "public_transport": ("platform",),
    "shop": (),
    "tourism": (),
    "waterway": ("canal", "dam", "ditch", "drain", "river", "stream", "weir"),
}
# Fixed values of the area tag: those that decide, and of them those that affirm.
DECISIVE = ("yes", "no", "true", "false", "1", "0")
AFFIRMATIVE = ("yes", "true", "1")
# Fixed values of the type tag of relations that are drawn as polygons.
POLYGON_TYPES = ("multipolygon", "boundary")
#: Byte codes of member types; they differ from the codes in packed keys.
MEMBER_CODES = {"node": 1, "way": 2, "relation": 3}


def is_area(tags: Column) -> Column:
    """Whether a closed way with these tags is an area; false for null tags."""
    area = F.lower(F.try_element_at(tags, F.lit("area")))
    keys = F.array_intersect(F.map_keys(tags), F.array(*map(F.lit, AREA_KEYS)))
    exceptions = F.create_map(*[x for k, v in AREA_KEYS.items() for x in (F.lit(k), F.array(*map(F.lit, v)) if v else F.array().cast("array<string>"))])
    by_key = F.exists(keys, lambda k: ~F.array_contains(F.element_at(exceptions, k), F.coalesce(F.element_at(tags, k), F.lit(""))))
    return F.coalesce(F.when(area.isin(*DECISIVE), area.isin(*AFFIRMATIVE)).otherwise(by_key), F.lit(False))


def is_multipolygon(tags: Column) -> Column:
    return F.coalesce(F.lower(F.try_element_at(tags, F.lit("type"))).isin(*POLYGON_TYPES), F.lit(False))


def is_route(tags: Column) -> Column:
    """Case matters here."""
    return F.coalesce(F.try_element_at(tags, F.lit("type")) == "route", F.lit(False))


def merge_tags(a: Column, b: Column) -> Column:
    """All tags of both; b wins. Null if either is null."""
    return F.map_zip_with(a, b, lambda _, x, y: F.coalesce(y, x))


def compress_members(members: Column) -> Column:
    """Members with their types as bytes 1, 2, 3; an unknown type raises."""

    def code(kind: Column) -> Column:
        c = F.raise_error(F.concat(F.lit("unknown member type: "), F.coalesce(kind, F.lit("null")))).cast("tinyint")
        for name, k in MEMBER_CODES.items():
            c = F.when(kind == name, F.lit(k).cast("tinyint")).otherwise(c)
        return c

    return F.transform(members, lambda m: F.struct(code(m["type"]).alias("type"), m["ref"].alias("ref"), m["role"].alias("role")))


def tags_json(tags: Column) -> Column:
    return F.to_json(tags)
