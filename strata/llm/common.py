"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import strata

from strata.session import delete_path, scratch_dir

#: The white space of the word contract: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"


def ship(spark: SparkSession) -> None:
    """Gives this package to the Python workers of the session's executors, once
    for each context, so that they needn't have it installed."""
    context = spark.sparkContext
    if getattr(context, "_strata_shipped", False):
        return
    top = Path(strata.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="strata-py-")) / "strata.zip"
    with zipfile.ZipFile(path, "w") as packed:
        for file in sorted(top.rglob("*.py")):
            packed.write(file, file.relative_to(top.parent))
    context.addPyFile(str(path))  # served by the driver
    context._strata_shipped = True


#: Whether the shuffle files of a query go when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str, over: Sequence[DataFrame] = ()) -> DataFrame:
    """Writes ``df`` below ``spark.checkpoint.dir`` and reads it back: cuts the
    lineage with files every executor can reach, so a lost executor costs a
    reread and not a recomputation. The write's shuffles go when it has ended, and
    so do ``over``, materialised tables that no one reads after it."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    for old in over:
        delete_path(spark, old._materialised)
    back = spark.read.schema(df.schema).parquet(path)
    back._materialised = path
    return back


#: Rows and bytes of text that an operator takes from a batch at a time, so that a
#: worker holds few Python objects beside the batch.
SLICE_ROWS, SLICE_BYTES = 1024, 4 << 20


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, length) of the parts of an array of texts, in order and without gaps."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(size):
        before = size[start - 1] if start else 0
        end = max(start + 1, min(start + SLICE_ROWS, int(np.searchsorted(size, before + SLICE_BYTES, "right"))))
        yield start, min(end, len(size)) - start
        start = min(end, len(size))


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array (null: empty)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[ \t\n\x0B\f\r]+"))


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")
