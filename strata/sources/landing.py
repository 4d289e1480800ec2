"""Landing zones for the ingest queries: Spark writes a table out as source
files, one ``batch_key=<b>`` directory per batch, in any supported format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def land(df: DataFrame, path: str, fmt: str, batch_col: str = "batch_key", files_per_batch: int | None = None,
         text_sep: str = "|", by_batch: bool = False) -> None:
    """Write ``df`` as ``fmt`` files partitioned by ``batch_col`` (append, so a
    zone can receive several drops). Text landing joins the columns with
    ``text_sep`` into one ``value`` line. ``by_batch``: tasks write whole
    batches, and several one that is large (fewer, larger files), instead of one
    file per task and batch; ``df`` is evaluated once. With ``files_per_batch``
    so many tasks write contiguous batch ranges."""
    out = df
    if fmt == "text":
        data = [c for c in df.columns if c != batch_col]
        out = df.select(F.concat_ws(text_sep, *[F.col(c).cast("string") for c in data]).alias("value"),
                        batch_col)
    if files_per_batch:
        # contiguous ranges of batches per task: about one file per batch, and
        # the row hash splits a batch that holds a large share of the rows
        order = [F.col(batch_col), F.xxhash64(*[F.col(c) for c in out.columns])]
        out = out.repartitionByRange(files_per_batch, *order)
    elif by_batch:
        out = out.hint("rebalance", F.col(batch_col))
    w = out.write.mode("append").partitionBy(batch_col)
    if fmt == "csv":
        w = w.option("header", "true")
    w.format(fmt).save(path)
