"""Key packing, partition numbers and small scalar functions, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import TYPES

#: Partition numbers are the leading decimal digits of an id, at most this much.
LARGEST = 1 << 11


def type_code(kind: Column) -> Column:
    """0, 1, 2 for node, way, relation; anything else, null included, raises."""
    code = F.raise_error(F.concat(F.lit("unknown entity type: "), F.coalesce(kind, F.lit("null")))).cast("long")
    for k, name in reversed(list(enumerate(TYPES))):
        code = F.when(kind == name, F.lit(k).cast("long")).otherwise(code)
    return code


def pack(id_: Column, kind: Column) -> Column:
    """(id << 2) | type code, unique over all entities for |id| < 2**61; null id gives null."""
    return F.shiftleft(id_.cast("long"), 2).bitwiseOR(type_code(kind))


def unpack_id(key: Column) -> Column:
    return F.shiftright(key, 2)


def unpack_type(key: Column) -> Column:
    """The type of a packed key; raises for the unused code."""
    code = key.bitwiseAND(F.lit(3).cast("long"))
    return F.when(key.isNull(), None).when(code < 3, F.element_at(F.array(*map(F.lit, TYPES)), F.least(code, F.lit(2)).cast("int") + 1)).otherwise(F.raise_error("key without a type").cast("string"))


def partition_number(id_: Column, kind: Column) -> Column:
    """Leading decimal digits of the id that make at most LARGEST, xor the type code. Ids below 0 stay as they are."""
    id_ = id_.cast("long")
    lead = F.coalesce(*[F.when(x <= LARGEST, x) for x in (F.call_function("div", id_, F.lit(10**k).cast("long")) for k in range(17))])
    return lead.bitwiseXOR(type_code(kind))


def larger(x: Column, y: Column) -> Column:
    """The larger of two; null if either is null."""
    return F.when(x.isNotNull() & y.isNotNull(), F.greatest(x, y))


def instant(ts: Column) -> Column:
    """Epoch milliseconds, truncated."""
    return F.unix_millis(ts.cast("timestamp"))


def three_digits(n: Column) -> Column:
    """The last three digits, zero-padded."""
    return F.lpad(F.right(n.cast("string"), F.lit(3)), 3, "0")


def as_double(x: Column) -> Column:
    return F.coalesce(x.cast("double"), F.lit(float("nan")))


def as_float(x: Column) -> Column:
    return F.coalesce(x.cast("float"), F.lit(float("nan")).cast("float"))
