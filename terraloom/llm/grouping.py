"""Streaming over the groups of a key: each partition is sorted, and a group's rows pass by in slices."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def _runs(keys: np.ndarray) -> np.ndarray:
    return np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys))


def fold_groups(df: DataFrame, key: str, start: Callable, fold: Callable, finish: Callable, schema, flush: int = 2000) -> DataFrame:
    """For each value of key (a non-null long, the first column): start() makes a state, fold(state, slice)
    takes in the group's rows (arrow slices without the key, a group may come in several), and
    finish(key, state) gives a tuple of output values or None. Memory: one state and flush rows.
    """
    rest = [c for c in df.columns if c != key]

    def run(batches: Iterator[pa.RecordBatch]):
        now, state, out, kinds = None, None, [], None

        def rows():
            cols = list(zip(*out, strict=True)) if out else [[] for _ in kinds]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=schema.names)

        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in schema.fields]
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            edge = _runs(keys)
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                if state is None or keys[a] != now:
                    if state is not None and (made := finish(now, state)) is not None:
                        out.append(made)
                    now, state = int(keys[a]), start()
                state = fold(state, batch.slice(a, b - a))
                if len(out) >= flush:
                    yield rows()
                    out = []
        if state is not None and (made := finish(now, state)) is not None:
            out.append(made)
        yield rows()

    return df.select(key, *rest).repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)
