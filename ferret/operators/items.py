"""Apply a user function to every item of a table, in parallel.

The reference maps a function over an iterable with a pool of N workers.
Here the items are rows of a DataFrame, the workers are Spark tasks
(``repartition(n)``), the function sees Arrow batches through
``mapInPandas`` and returns rows instead of side effects.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def map_items(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
              num_workers: int | None = None) -> DataFrame:
    """Run ``fn`` on batches of rows; at least ``num_workers`` tasks share the items.

    The worker count only ever raises parallelism: a large table keeps its own
    (larger) partitioning instead of being squeezed into ``num_workers`` tasks.
    """
    src = df
    if num_workers and num_workers > df.rdd.getNumPartitions():
        src = df.repartition(num_workers)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = fn(pdf)
            if out is not None and len(out):
                yield out

    return src.mapInPandas(run, schema)


# Fixed value: what counts as an element start tag.
TAG = re.compile(r"<([a-zA-Z][a-zA-Z0-9]*)")


def page_elements(pdf: pd.DataFrame) -> pd.DataFrame:
    """Demo item function: count element tags in each page's html."""
    rows = []
    for pid, html in zip(pdf["page_id"], pdf["html"]):
        counts: dict[str, int] = {}
        for tag in TAG.findall(html or ""):
            counts[tag] = counts.get(tag, 0) + 1
        rows.extend((pid, t, c) for t, c in counts.items())
    return pd.DataFrame(rows, columns=["page_id", "element", "n"])
