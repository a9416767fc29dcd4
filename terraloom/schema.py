"""The entity table: nodes, ways and relations with all their versions, one row each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DecimalType, LongType, MapType, StringType, StructField, StructType, TimestampType

NODE, WAY, RELATION = "node", "way", "relation"
TYPES = (NODE, WAY, RELATION)

LAT, LON = DecimalType(9, 7), DecimalType(10, 7)
VERTEX = StructType([StructField("ref", LongType())])
MEMBER = StructType([StructField("type", StringType()), StructField("ref", LongType()), StructField("role", StringType())])

STORED = StructType([
    StructField("id", LongType()), StructField("type", StringType()), StructField("tags", MapType(StringType(), StringType())),
    StructField("lat", LAT), StructField("lon", LON), StructField("nds", ArrayType(VERTEX)), StructField("members", ArrayType(MEMBER)),
    StructField("changeset", LongType()), StructField("timestamp", TimestampType()), StructField("uid", LongType()), StructField("user", StringType()),
    StructField("version", LongType()), StructField("visible", BooleanType()),
])
ENTITY = StructType([StructField("p", LongType()), *STORED.fields])
EDGE = StructType([StructField("a", LongType(), False), StructField("b", LongType(), False)])

#: Where a row of the working set comes from, best first.
UPDATE, MEMORY, STORAGE = "update", "memory", "storage"
RANK = {UPDATE: 0, MEMORY: 1, STORAGE: 2}


def entities(df: DataFrame) -> DataFrame:
    """The canonical columns in order; missing ones are null, p is derived if it is missing."""
    from .functions.keys import partition_number

    if "p" not in df.columns:
        df = df.withColumn("p", partition_number(F.col("id"), F.col("type")))
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in ENTITY.fields])
