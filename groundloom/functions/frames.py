"""Extension points for user functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame


def scene_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, scene: Sequence[str]) -> DataFrame:
    """Apply a pandas function to every whole scene, the rows that share the columns ``scene``.

    A scene is handed over as one frame and has to fit into a task's memory. Prefer ``df.transform`` with column
    expressions; this is for code that has none. See :func:`row_apply` for functions of single rows.
    """
    return df.groupBy(*scene).applyInPandas(fn, schema)


def row_apply(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Add the columns a vectorised row function returns; ``schema`` lists only the new ones."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.concat([part, fn(part)], axis=1)

    return df.mapInPandas(batches, f"{kept}, {schema}")
