"""The function library under SQL names."""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import geo, keys, tags


def register(spark: SparkSession) -> None:
    """Make the library callable from SQL: st_* as registered UDFs, the others as SQL functions over native expressions."""
    from ..operators.render import multipolygon_wkb, route_wkb

    for name in ("st_astext", "st_isempty", "st_isvalid", "st_point", "st_transform_to"):
        spark.udf.register(f"geo_{name}", getattr(geo, name))
    spark.udf.register("geo_multipolygon", multipolygon_wkb)  # (array of (type, role, wkb)) -> wkb, null if it can't be assembled
    spark.udf.register("geo_route", route_wkb)  # (array of (type, role, wkb)) -> array of (role, wkb), null if a way has no geometry
    code = "CASE kind WHEN 'node' THEN 0L WHEN 'way' THEN 1L WHEN 'relation' THEN 2L ELSE raise_error(concat('unknown entity type: ', coalesce(kind, 'null'))) END"
    lead = "coalesce(" + ", ".join(f"CASE WHEN id div {10**k}L <= {keys.LARGEST} THEN id div {10**k}L END" for k in range(17)) + ")"
    truthy, decisive = (", ".join(f"'{v}'" for v in values) for values in (tags.AFFIRMATIVE, tags.DECISIVE))
    areas = " OR ".join(f"(map_contains_key(tags, '{k}')" + (f" AND tags['{k}'] NOT IN ({', '.join(repr(x) for x in v)})" if v else "") + ")" for k, v in tags.AREA_KEYS.items())
    poly = ", ".join(f"'{v}'" for v in tags.POLYGON_TYPES)
    bodies = {
        "geo_pack(id BIGINT, kind STRING) RETURNS BIGINT": f"shiftleft(id, 2) | {code}",
        "geo_unpack_id(k BIGINT) RETURNS BIGINT": "shiftright(k, 2)",
        "geo_unpack_type(k BIGINT) RETURNS STRING": "CASE WHEN k IS NULL THEN NULL WHEN (k & 3) = 0 THEN 'node' WHEN (k & 3) = 1 THEN 'way' WHEN (k & 3) = 2 THEN 'relation' ELSE raise_error('key without a type') END",
        "geo_partition(id BIGINT, kind STRING) RETURNS BIGINT": f"{lead} ^ {code}",
        "geo_larger(x DOUBLE, y DOUBLE) RETURNS DOUBLE": "CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN greatest(x, y) END",
        "geo_instant(ts TIMESTAMP) RETURNS BIGINT": "unix_millis(ts)",
        "geo_three_digits(n BIGINT) RETURNS STRING": "lpad(right(CAST(n AS STRING), 3), 3, '0')",
        "geo_as_double(x DECIMAL(38, 18)) RETURNS DOUBLE": "coalesce(CAST(x AS DOUBLE), double('NaN'))",
        "geo_as_float(x DECIMAL(38, 18)) RETURNS FLOAT": "coalesce(CAST(x AS FLOAT), float('NaN'))",
        "geo_compress_members(members ARRAY<STRUCT<type: STRING, ref: BIGINT, role: STRING>>) RETURNS ARRAY<STRUCT<type: TINYINT, ref: BIGINT, role: STRING>>": "transform(members, m -> named_struct('type', CAST(CASE m.type WHEN 'node' THEN 1 WHEN 'way' THEN 2 WHEN 'relation' THEN 3 ELSE raise_error('unknown member type') END AS TINYINT), 'ref', m.ref, 'role', m.role))",
        "geo_is_area(tags MAP<STRING, STRING>) RETURNS BOOLEAN": f"coalesce(CASE WHEN lower(tags['area']) IN ({decisive}) THEN lower(tags['area']) IN ({truthy}) ELSE {areas} END, false)",
        "geo_is_multipolygon(tags MAP<STRING, STRING>) RETURNS BOOLEAN": f"coalesce(lower(tags['type']) IN ({poly}), false)",
        "geo_is_route(tags MAP<STRING, STRING>) RETURNS BOOLEAN": "coalesce(tags['type'] = 'route', false)",
        "geo_merge_tags(a MAP<STRING, STRING>, b MAP<STRING, STRING>) RETURNS MAP<STRING, STRING>": "map_zip_with(a, b, (k, x, y) -> coalesce(y, x))",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
