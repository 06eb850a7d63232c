"""Models over Arrow batches: loaded once per worker, with a backbone whose output all heads share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from crateflow.operators.vectors import _matrix

_LOADED: dict = {}


def _once(loader: Callable):
    key = (loader.__module__, loader.__qualname__)
    if key not in _LOADED:
        _LOADED[key] = loader()
    return _LOADED[key]


def scored(df: DataFrame, key: str, field: str, dim: int, loader: Callable[[], tuple[Callable, dict[str, Callable]]], heads: list[str]) -> DataFrame:
    """(key, one score a head) of every row that has a vector of ``dim`` values; others have none.

    ``loader`` gives the backbone and the heads by name; the backbone runs once a batch.
    """
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backbone, have = _once(loader)
        for b in batches:
            shared = backbone(_matrix(b.column(1), dim))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(np.asarray(have[h](shared), float)) for h in heads)], [key, *heads])

    return df.where(f"size({field}) = {dim}").select(key, field).mapInArrow(run, f"{key} {kind}, " + ", ".join(f"{h} double" for h in heads))
