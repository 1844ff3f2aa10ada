"""Folds over ordered groups whose state no window frame can carry.

Groups are dealt by key, sorted, and streamed: a task holds one batch and one group's state, whatever the group's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame


def fold(df: DataFrame, keys: list[str], order: list[str | Column], start: Callable, schema: str) -> DataFrame:
    """``start(key)`` makes a fold with ``row(r) -> rows`` and ``end() -> rows``; rows of ``schema`` are tuples."""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def run(batches):
        key, state = None, None
        for batch in batches:
            out: list[tuple] = []
            for r in batch.itertuples(index=False):
                own = tuple(None if pd.isna(x) else x for x in (getattr(r, k) for k in keys))
                if state is None or own != key:
                    if state is not None:
                        out += state.end()
                    key, state = own, start(own)
                out += state.row(r)
            yield pd.DataFrame(out, columns=names)
        if state is not None:
            yield pd.DataFrame(state.end(), columns=names)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


class Fold:
    """Emits nothing; folds override what they need."""

    def row(self, r) -> Iterable[tuple]:
        return []

    def end(self) -> Iterable[tuple]:
        return []


