"""Repeated lines, found through sharded minimal perfect hashes.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with
A-Z in lower case; keys of at least 20 code points count, by a 128-bit hash.
Distinct hashes are dealt into shards of bounded size; a shard is a minimal
perfect hash over its hashes that indexes three compact arrays: a 32-bit
fingerprint, the number of documents and the largest document id. Documents
send the hashes of their lines to the shards and probe the arrays there; no
line is joined with a line. A shard that is probed often (one line in a third
of all documents) is copied, and its probes are salted over the copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import BLANKS, materialise, slices
from strata.llm.perfect import PerfectHash, mixed

_STRIP = BLANKS.encode()
#: Distinct lines in a shard, and probes that one copy of a shard gets.
SHARD_LINES = 100_000
COPY_PROBES = 400_000
HASHED = "doc long, high long, low long"


def _key(line: bytes, least: int) -> bytes | None:
    """The 128-bit hash of a line's key, or None of a short one."""
    key = line.strip(_STRIP).lower()
    if len(key) < least or len(key) < 4 * least and len(key.decode("utf-8", "replace")) < least:
        return None
    return xxhash.xxh3_128_digest(key)


def _hashes(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, length in slices(batch.column(1)):
                part, keys, many = batch.slice(start, length), [], []
                for text in part.column(1).to_pylist():
                    own = {k for line in text.split(b"\n") if (k := _key(line, least))}
                    keys.extend(own)
                    many.append(len(own))
                both = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
                ids = part.column(0).take(pa.array(np.repeat(np.arange(length), many)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1]))],
                    ["doc", "high", "low"])

    return run


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    """One shard's hash and arrays."""
    high, low = pdf["high"].to_numpy(), pdf["low"].to_numpy()
    hashed = PerfectHash.over(high, low)
    place = hashed.index(high, low)
    fingerprint, count, keeper = (np.empty(len(high), t) for t in (np.uint32, np.uint32, np.int64))
    fingerprint[place] = mixed(low, high, 1).astype(np.uint32)
    count[place] = np.minimum(pdf["n"].to_numpy(), 2**32 - 1)
    keeper[place] = pdf["keeper"].to_numpy()
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "sizes": [hashed.sizes.tobytes()],
                         "bits": [hashed.bits.tobytes()], "fingerprint": [fingerprint.tobytes()],
                         "count": [count.tobytes()], "keeper": [keeper.tobytes()]})


def _probe(min_docs: int):
    def run(lines: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
        if not len(lines) or not len(arrays):
            return pd.DataFrame({"doc": pd.Series([], dtype="Int64"), "high": np.zeros(0, np.int64),
                                 "low": np.zeros(0, np.int64)})
        shard = arrays.iloc[0]
        hashed = PerfectHash(np.frombuffer(shard["sizes"], np.int64), np.frombuffer(shard["bits"], np.uint8))
        high, low = lines["high"].to_numpy(), lines["low"].to_numpy()
        place = hashed.index(high, low)
        known = place >= 0
        known &= np.frombuffer(shard["fingerprint"], np.uint32)[place] == mixed(low, high, 1).astype(np.uint32)
        often = known & (np.frombuffer(shard["count"], np.uint32)[place] >= min_docs)
        owner = np.frombuffer(shard["keeper"], np.int64)[place]
        has_id = lines["has_id"].to_numpy()
        drop = often & ~(has_id & (lines["doc"].to_numpy() == owner))
        out = lines.loc[drop, ["high", "low"]]
        ids = pd.array(lines.loc[drop, "doc"], dtype="Int64")
        ids[~has_id[drop]] = pd.NA
        return out.assign(doc=ids)[["doc", "high", "low"]]

    return run


def hashed_lines(docs: DataFrame, least: int = 20) -> DataFrame:
    """(doc, high, low): each document's distinct line keys; ``doc`` may be null."""
    return docs.select(F.col("doc_id").cast("long").alias("doc"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(_hashes(least), HASHED)


def shards(counted: DataFrame, number: int) -> DataFrame:
    """The perfect hashes with their arrays over (high, low, n, keeper), one row
    a shard, at least one column of bytes for each array."""
    dealt = counted.withColumn("shard", F.pmod("high", F.lit(number)).cast("long"))
    return dealt.groupBy("shard").applyInPandas(
        _build, "shard long, sizes binary, bits binary, fingerprint binary, count binary, keeper binary")


def repeated_lines(docs: DataFrame, least: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc, high, low) of the line keys that a document loses."""
    lines = materialise(hashed_lines(docs, least), "lines")
    # repeated ids are one document; the hot keys shrink to a row a task before they meet
    counted = materialise(
        lines.groupBy("high", "low", "doc").agg(F.lit(1).alias("one")).groupBy("high", "low")
        .agg(F.count("*").alias("n"), F.coalesce(F.max("doc"), F.lit(0)).cast("long").alias("keeper")), "line-counts")
    number = max(1, -(-counted.count() // SHARD_LINES))
    arrays = materialise(shards(counted, number), "line-shards")
    load = (counted.groupBy(F.pmod("high", F.lit(number)).cast("long").alias("shard")).agg(F.sum("n").alias("n"))
            .select("shard", F.ceil(F.col("n") / COPY_PROBES).cast("long").alias("copies")))
    copies = arrays.join(load, "shard").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    probes = lines.withColumn("shard", F.pmod("high", F.lit(number)).cast("long")).join(load, "shard").select(
        F.coalesce("doc", F.lit(0).cast("long")).alias("doc"), F.col("doc").isNotNull().alias("has_id"), "high", "low",
        "shard", F.pmod(F.xxhash64("doc"), F.col("copies")).alias("copy"))
    return probes.groupBy("shard", "copy").cogroup(copies.groupBy("shard", "copy")).applyInPandas(_probe(min_docs), HASHED)


def _made(out: list, lost: list) -> pa.Array:
    return pa.StructArray.from_arrays(
        [pa.array(out, pa.binary()), pa.array([x[0] for x in lost], pa.int64()),
         pa.array([x[1] for x in lost], pa.int64())], ["text", "n_lines", "n_dropped"])


def _without(least: int):
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, dropped in batches:
            if not len(texts):
                yield _made([], [])
            for start, length in slices(texts):
                out, lost = [], []
                for text, drop in zip(texts.slice(start, length).to_pylist(), dropped.slice(start, length).to_pylist(), strict=True):
                    if text is None:
                        out.append(None)
                        lost.append((1, 0))
                        continue
                    lines = text.split(b"\n")
                    if drop:
                        gone = {np.array([x["high"], x["low"]], np.int64).tobytes() for x in drop}
                        kept = [x for x in lines if _key(x, least) not in gone]
                        out.append(b"\n".join(kept))
                        lost.append((len(lines), len(lines) - len(kept)))
                    else:
                        out.append(text)
                        lost.append((len(lines), 0))
                yield _made(out, lost)

    return F.arrow_udf(run, "text binary, n_lines long, n_dropped long")


def drop_repeated_lines(docs: DataFrame, least: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` without the lines whose key (of at least ``least`` code points)
    occurs in at least ``min_docs`` documents, except in the largest ``doc_id``
    that has it, plus ``n_lines`` (before) and ``n_dropped``.

    A null text stays null and counts as one empty line, so does an empty one.
    Rows of one id are one document and all keep what it keeps; rows without an
    id together count as one document that never keeps. Columns named like the
    two new ones give way; an empty table stays empty.
    """
    lost = repeated_lines(docs, least, min_docs).groupBy("doc").agg(
        F.collect_list(F.struct("high", "low")).alias("dropped"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"))
    met = rows.join(lost, F.col("id").eqNullSafe(F.col("doc")), "left")
    made = met.select("row", _without(least)(F.col("row.text").cast("binary"), F.col("dropped")).alias("made"))
    taken = {"n_lines", "n_dropped"}
    return made.select(
        *[(F.col("made.text").cast("string").alias(c) if c == "text" else F.col(f"row.`{c}`"))
          for c in docs.columns if c.lower() not in taken],
        F.col("made.n_lines").alias("n_lines"), F.col("made.n_dropped").alias("n_dropped"))
