"""Numbered files: path templates, fetching and retries."""

from __future__ import annotations

import os
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from itertools import count, islice

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import three_digits


def sequence_path(template: Column, number: Column) -> Column:
    """The template with AAA, BBB, CCC replaced by the number's millions, thousands and units, three digits each."""
    n = number.cast("long")
    parts = {"AAA": F.call_function("div", n, F.lit(1_000_000).cast("long")), "BBB": F.call_function("div", n, F.lit(1000).cast("long")), "CCC": n}
    out = template
    for name, part in parts.items():
        out = F.replace(out, F.lit(name), three_digits(part % 1000))
    return out


def path_of(template: str, number: int) -> str:
    for name, unit in (("AAA", 1_000_000), ("BBB", 1000), ("CCC", 1)):
        template = template.replace(name, f"{number // unit % 1000:03d}")
    return template


def numbers(start: int, end: int) -> Iterator[int]:
    """start to end, both included; without end if end is -1."""
    return count(start) if end == -1 else islice(count(start), max(0, end - start + 1))


def with_retries(work: Callable, attempts: int = 9, first_wait: float = 2.0, sleep: Callable = time.sleep, errors: tuple = (OSError, ValueError)):
    """work(), tried again after waits that double; the last failure is raised, no file is skipped."""
    for k in range(attempts):
        try:
            return work()
        except errors:
            if k == attempts - 1:
                raise
            sleep(first_wait * 2**k)


def _remote(path: str) -> bool:
    return path.startswith(("http://", "https://"))


def present(path: str) -> bool:
    """Whether a file is there: local, http(s), or of a file system that pyarrow knows."""
    if _remote(path):
        try:
            with urllib.request.urlopen(urllib.request.Request(path, method="HEAD"), timeout=60):
                return True
        except urllib.error.HTTPError as e:
            if e.code in (403, 404, 410):
                return False
            raise
    if "://" in path and not path.startswith("file://"):
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(path)
        return system.get_file_info(inner).type == fs.FileType.File
    return os.path.exists(path.removeprefix("file://"))


def fetched(spark: SparkSession, path: str, folder: str) -> str:
    """A path that all executors can read: http(s) files are copied into the shared folder, others are read in place."""
    if not _remote(path):
        return path
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{os.path.basename(urllib.parse.urlparse(path).path)}")
    with urllib.request.urlopen(path, timeout=60) as r:
        out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
        try:
            while piece := r.read(1 << 20):
                out.write(bytearray(piece))
        finally:
            out.close()
    return target.toString()
