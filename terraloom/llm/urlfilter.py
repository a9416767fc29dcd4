"""URL filter: a broadcast trie over reversed host labels, then path segments.

The host is what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with
A-Z lower-cased; the path is what follows up to ``?``, ``#`` or the end; both are empty for
null urls and urls without ``://``. A rule fits its host and all subdomains if the url's
path starts with the rule's path, character by character. Of the rules that fit, the one with
the most host labels wins, then the one with the longest path; of equal rules block wins.
If none fits, ``default`` is the verdict and the rule is null.

Rules are broadcast; more than ``MAX_RULES`` are refused, as the trie would no longer be of
a bounded size.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .runtime import free_name, kept_columns

MAX_RULES = 2_000_000
_NEW = ("host", "path", "rule", "verdict")
_FOLD = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def split_url(url: str | None) -> tuple[str, str]:
    at = url.find("://") if url is not None else -1
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    end = min((k for k in (rest.find("?"), rest.find("#")) if k >= 0), default=len(rest))
    rest = rest[:end]
    slash = rest.find("/")
    return (rest.translate(_FOLD), "") if slash < 0 else (rest[:slash].translate(_FOLD), rest[slash:])


class _Node:
    __slots__ = ("labels", "paths")

    def __init__(self):
        self.labels: dict[str, _Node] = {}
        self.paths: _Path | None = None


class _Path:
    """Node of a path trie: whole segments lead on, the start of a segment ends a rule."""

    __slots__ = ("starts", "segments")

    def __init__(self):
        self.segments: dict[str, _Path] = {}
        self.starts: dict[str, tuple[str, str]] = {}


class UrlTrie:
    def __init__(self, rules: list[tuple[str, str, str]], default: str = "allow"):
        """rules: (verdict, host, path), verdict being allow or block."""
        if len(rules) > MAX_RULES:
            raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are broadcast")
        self.root, self.default = _Node(), default
        for verdict, host, path in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"unknown verdict {verdict!r}")
            host, node = host.translate(_FOLD), self.root
            for label in reversed(host.split(".")):
                node = node.labels.setdefault(label, _Node())
            node.paths = at = node.paths or _Path()
            *whole, start = path.split("/")
            for segment in whole:
                at = at.segments.setdefault(segment, _Path())
            if at.starts.get(start, ("allow",))[0] != "block":
                at.starts[start] = (verdict, host + path)

    @staticmethod
    def _longest(at: _Path, path: str) -> tuple[str, str] | None:
        best = None
        for segment in path.split("/"):
            fits = [s for s in at.starts if segment.startswith(s)] if len(at.starts) <= len(segment) else [segment[:k] for k in range(len(segment) + 1) if segment[:k] in at.starts]
            if fits:
                best = at.starts[max(fits, key=len)]
            at = at.segments.get(segment)
            if at is None:
                break
        return best

    def judge(self, host: str, path: str) -> tuple[str, str | None]:
        """(verdict, rule or None)."""
        node, best = self.root, None
        for label in reversed(host.split(".")):
            node = node.labels.get(label)
            if node is None:
                break
            if node.paths is not None:
                best = self._longest(node.paths, path) or best
        return best or (self.default, None)


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow", url_col: str = "url") -> DataFrame:
    """pages' columns without the url, and host, path, rule and verdict; columns that pages has of these names are replaced."""
    kept = kept_columns(pages, url_col, _NEW)
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules, default))

    def run(batches):
        for batch in batches:
            parts = [split_url(u.as_py()) for u in batch.column(len(kept))]
            said = [trie.value.judge(h, p) for h, p in parts]
            cols = [[h for h, _ in parts], [p for _, p in parts], [r for _, r in said], [v for v, _ in said]]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *(pa.array(c, pa.string()) for c in cols)], names=[*kept, *_NEW])

    schema = StructType([*pages.select(*kept).schema.fields, *(StructField(n, StringType()) for n in _NEW)])
    return pages.select(*kept, F.col(url_col).alias(free_name(pages, "__url"))).mapInArrow(run, schema)
