from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from terraloom.functions import keys, registry, tags

IDS = [0, 1, 7, 2047, 2048, 2049, 20489, 20490, 123456789, -1, -2049, 2**61 - 1, 2**63 - 1]


def model_partition(i, code):
    while i > 2048:
        i //= 10
    return i ^ code


def test_partition_numbers(spark):
    df = spark.createDataFrame([(i, t) for i in IDS for t in ("node", "way", "relation")], "id long, type string")
    for r in df.withColumn("p", keys.partition_number(F.col("id"), F.col("type"))).collect():
        assert r.p == model_partition(r.id, ("node", "way", "relation").index(r.type))
        assert r.id < 0 or 0 <= r.p <= 2050


def test_keys_round_trip(spark):
    df = spark.createDataFrame([(i, t) for i in IDS[:-1] for t in ("node", "way", "relation")] + [(None, "node")], "id long, type string")
    k = df.withColumn("k", keys.pack(F.col("id"), F.col("type")))
    for r in k.select("*", keys.unpack_id(F.col("k")).alias("i"), keys.unpack_type(F.col("k")).alias("t")).collect():
        assert (r.i, r.t) == (r.id, r.type if r.id is not None else None)


@pytest.mark.parametrize("kind", ["'area'", "cast(null as string)"])
def test_unknown_types_raise(spark, kind):
    with pytest.raises(Exception, match="unknown entity type"):
        spark.range(1).select(keys.pack(F.col("id"), F.expr(kind))).collect()
    with pytest.raises(Exception, match="key without a type"):
        spark.range(1).select(keys.unpack_type(F.lit(3).cast("long"))).collect()


def test_small_scalars(spark):
    r = spark.sql("SELECT 1.5D a, cast(null as double) n, timestamp'2024-01-02 03:04:05.678901' t, 7L s, 123456L b, cast(null as decimal(9,7)) d").select(
        keys.larger(F.col("a"), F.lit(2.0)).alias("l"), keys.larger(F.col("a"), F.col("n")).alias("ln"), keys.instant(F.col("t")).alias("i"),
        keys.three_digits(F.col("s")).alias("s"), keys.three_digits(F.col("b")).alias("b"), F.isnan(keys.as_double(F.col("d"))).alias("d"), F.isnan(keys.as_float(F.col("d"))).alias("f"),
    ).first()
    assert (r.l, r.ln, r.i, r.s, r.b, r.d, r.f) == (2.0, None, 1704164645678, "007", "456", True, True)


CASES = [
    ({}, False), (None, False), ({"building": "yes"}, True), ({"building": "no"}, True), ({"amenity": "bench"}, False), ({"amenity": "cafe"}, True),
    ({"area": "YES"}, True), ({"area": "no", "building": "yes"}, False), ({"area": "maybe", "building": "yes"}, True), ({"area": "0"}, False), ({"area": "1"}, True),
    ({"addr:*": "x"}, True), ({"addr:street": "x"}, False), ({"natural": "cliff", "leisure": "track"}, False), ({"natural": "cliff", "leisure": "park"}, True), ({"highway": "x"}, False),
]


def test_areas(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, tags map<string,string>")
    registry.register(spark)
    for r in df.select("i", tags.is_area(F.col("tags")).alias("a"), F.expr("geo_is_area(tags)").alias("b")).collect():
        assert r.a == r.b == CASES[r.i][1], CASES[r.i]


def test_relation_kinds_and_merging(spark):
    df = spark.createDataFrame([({"type": "Boundary"}, {"a": "1", "b": "2"}, {"b": "3"}), ({"type": "route"}, {}, None), ({"type": "Route"}, {}, {})], "t map<string,string>, a map<string,string>, b map<string,string>")
    out = df.select(tags.is_multipolygon(F.col("t")).alias("m"), tags.is_route(F.col("t")).alias("r"), tags.merge_tags(F.col("a"), F.col("b")).alias("x")).collect()
    assert [(r.m, r.r) for r in out] == [(True, False), (False, True), (False, False)]
    assert out[0].x == {"a": "1", "b": "3"} and out[1].x is None and out[2].x == {}


def test_members_are_compressed(spark):
    df = spark.createDataFrame([([("node", 1, "a"), ("way", 2, None), ("relation", 3, "")],), (None,)], "m array<struct<type:string,ref:bigint,role:string>>")
    a, b = df.select(tags.compress_members(F.col("m")).alias("m")).collect()
    assert [tuple(x) for x in a.m] == [(1, 1, "a"), (2, 2, None), (3, 3, "")] and b.m is None


def test_sql_names(spark):
    registry.register(spark)
    r = spark.sql("SELECT geo_pack(5, 'way') k, geo_unpack_id(21) i, geo_unpack_type(21) t, geo_partition(20489, 'relation') p, geo_st_astext(geo_st_point(1.0D, 2.5D)) w, geo_merge_tags(map('a','1'), map('a','2')) m").first()
    assert (r.k, r.i, r.t, r.p, r.w, r.m) == (21, 5, "way", 2048 ^ 2, "POINT (1 2.5)", {"a": "2"})
