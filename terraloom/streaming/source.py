"""A streaming source of numbered files: one number after the other, each in a micro-batch of its own."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..sources.paths import path_of, present

SCHEMA = StructType([StructField("number", LongType()), StructField("path", StringType())])


class NumberedFiles(DataSource):
    """``format("numbered_files")`` with options template (AAA/BBB/CCC), start and end (-1: no end)."""

    @classmethod
    def name(cls) -> str:
        return "numbered_files"

    def schema(self) -> StructType:
        return SCHEMA

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        return _Reader(self.options["template"], int(self.options.get("start", "1")), int(self.options.get("end", "-1")))


class _Reader(SimpleDataSourceStreamReader):
    """Offsets are the next number to give out; a file that isn't there yet, local or remote, is waited for."""

    def __init__(self, template: str, start: int, end: int):
        self.template, self.start, self.end = template, start, end

    def initialOffset(self) -> dict:
        return {"next": self.start}

    def _row(self, number: int) -> tuple[int, str]:
        return number, path_of(self.template, number)

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        number = start["next"]
        if self.end != -1 and number > self.end:
            return iter([]), start
        row = self._row(number)
        if not present(row[1]):
            return iter([]), start
        return iter([row]), {"next": number + 1}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([self._row(n) for n in range(start["next"], end["next"])])

    def commit(self, end: dict) -> None:
        pass
