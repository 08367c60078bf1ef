"""Row functions that need set-up once per task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def map_with_lifecycle(
    df: DataFrame,
    opened: Callable[[], object],
    apply: Callable[[object, pd.DataFrame], pd.DataFrame],
    closed: Callable[[object], None],
    schema: str,
) -> DataFrame:
    """``apply`` on batches of rows, between one ``opened`` and one ``closed`` per task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = opened()
        try:
            for pdf in batches:
                yield apply(resource, pdf)
        finally:
            closed(resource)

    return df.mapInPandas(run, schema)
