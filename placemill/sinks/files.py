"""File exports."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def write_csv(df: DataFrame, path: str, *, run_id: str | None = None) -> str:
    """CSV with a header, replacing what is at the target. Returns the target.

    One folder for a table, written in parallel, a file for each task. ``run_id``
    stamps the folder, so runs stay side by side.
    """
    target = f"{path}/run={run_id}" if run_id else path
    df.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(target)
    return target


def write_parts(
    df: DataFrame, path: str, *, part: str = "part", fmt: str = "parquet", rebalance: bool = False
) -> None:
    """One folder per value of ``part`` (see ``split_contiguous``).

    Each task writes what it has of every part. ``rebalance`` shuffles rows by
    part first, into files of even size: fewer files if parts are scattered.
    """
    if rebalance:
        df = df.hint("rebalance", part)
    df.write.mode("overwrite").partitionBy(part).format(fmt).save(path)


def write_json_arrays(df: DataFrame, path: str) -> None:
    """One valid JSON array per output file, with one row per line.

    Readers must take an array file in one task, so keep partitions small. The
    rows of a partition pass through in batches and are never held together.
    """

    # Local, so that it travels by value and executors need not have this package.
    def as_array(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opening = "["
        for batch in batches:
            if len(batch):
                lines = "," + batch["value"]
                lines.iloc[0] = opening + batch["value"].iloc[0]
                opening = ","
                yield lines.to_frame()
        yield pd.DataFrame({"value": ["]" if opening == "," else "[]"]})

    rows = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    rows.mapInPandas(as_array, "value string").write.mode("overwrite").text(path)
