"""Change files (osmChange XML, plain or .gz or .bz2) as rows of the entity table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from ..schema import ENTITY, LAT, LON, MEMBER, NODE, RELATION, STORED, VERTEX, WAY, entities

_TAG = ArrayType(StructType([StructField("_k", StringType()), StructField("_v", StringType())]))
_META = [StructField("_id", LongType()), StructField("_version", LongType()), StructField("_timestamp", StringType()), StructField("_changeset", LongType()), StructField("_uid", LongType()), StructField("_user", StringType()), StructField("tag", _TAG)]
_NODE = StructType([*_META, StructField("_lat", DoubleType()), StructField("_lon", DoubleType())])
_WAY = StructType([*_META, StructField("nd", ArrayType(StructType([StructField("_ref", LongType())])))])
_RELATION = StructType([*_META, StructField("member", ArrayType(StructType([StructField("_type", StringType()), StructField("_ref", LongType()), StructField("_role", StringType())])))])
_BLOCK = ArrayType(StructType([StructField("node", ArrayType(_NODE)), StructField("way", ArrayType(_WAY)), StructField("relation", ArrayType(_RELATION))]))
ACTIONS = ("create", "modify", "delete")
CHANGE_FILE = StructType([StructField(a, _BLOCK) for a in ACTIONS])


def _full(e: DataFrame, kind: str) -> DataFrame:
    """A created or modified entity with all its fields."""
    x = lambda n: F.col(f"e.{n}")
    tags = F.coalesce(F.map_from_entries(F.transform(x("tag"), lambda t: F.struct(t["_k"], t["_v"]))), F.create_map().cast("map<string,string>"))
    place = (x("_lat").cast(LAT), x("_lon").cast(LON)) if kind == NODE else (F.lit(None).cast(LAT), F.lit(None).cast(LON))
    nds = F.transform(x("nd"), lambda n: F.struct(n["_ref"].alias("ref"))) if kind == WAY else F.lit(None)
    members = F.transform(x("member"), lambda m: F.struct(m["_type"].alias("type"), m["_ref"].alias("ref"), F.coalesce(m["_role"], F.lit("")).alias("role"))) if kind == RELATION else F.lit(None)
    return e.select(
        x("_id").alias("id"), F.lit(kind).alias("type"), tags.alias("tags"), place[0].alias("lat"), place[1].alias("lon"),
        F.coalesce(nds.cast(ArrayType(VERTEX)), F.array().cast(ArrayType(VERTEX))).alias("nds"), F.coalesce(members.cast(ArrayType(MEMBER)), F.array().cast(ArrayType(MEMBER))).alias("members"),
        x("_changeset").alias("changeset"), x("_timestamp").cast("timestamp").alias("timestamp"), x("_uid").alias("uid"), x("_user").alias("user"), x("_version").alias("version"), F.lit(True).alias("visible"),
    )


def _lesser(full: DataFrame) -> DataFrame:
    """A deleted entity: id, type, time and version are kept."""
    kept = {"id", "type", "timestamp", "version"}
    empty = {"tags": F.create_map(), "nds": F.array(), "members": F.array(), "visible": F.lit(False)}
    return full.select(*[(F.col(f.name) if f.name in kept else empty.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in STORED.fields])


def change_rows(files: DataFrame) -> DataFrame:
    """Entity rows of parsed change files (columns create, modify, delete)."""
    parts = []
    for action in ACTIONS:
        blocks = files.select(F.explode(action).alias("b"))
        for kind in (NODE, WAY, RELATION):
            full = _full(blocks.select(F.explode(f"b.{kind}").alias("e")), kind)
            parts.append(_lesser(full) if action == "delete" else full)
    return entities(reduce(DataFrame.unionByName, parts)).select(*[f.name for f in ENTITY.fields])


def read_changes(spark: SparkSession, *paths: str) -> DataFrame:
    """Entity rows of change files; the compression is told by the suffix."""
    files = spark.read.format("xml").option("rowTag", "osmChange").option("mode", "FAILFAST").schema(CHANGE_FILE).load(list(paths))
    return change_rows(files)
