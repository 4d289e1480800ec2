"""How filters interact: what every order of them removes, and what for nothing.

A document's failures are a bit mask, one bit a filter; documents with the same
mask (and labels) are alike for every order, so they are counted first. The
mask matrix (0 where a filter fails, infinity where it doesn't) and the matrix
of inverse permutations (the step at which an order has a filter) combine by
minimum and plus to the step that removes a document:

    removal[mask, order] = min over filters of (cost[mask, filter] + position[order, filter])

The counts of the masks are then scattered to those steps.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import words_of

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The filter that fails a text which a row of a smaller id has too.
COPY = "E"


def text_failures(text: Column) -> dict[str, Column]:
    """The filters on the text alone: few words, few distinct words, many
    capitals, any of ``#$%&*|``."""
    text = F.coalesce(text, F.lit(""))
    words = words_of(text)
    capitals = F.length(text) - F.length(F.translate(text, _UPPER, ""))
    return {"A": F.size(words) < 200,
            "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * F.size(words).cast("long"),
            "C": 100 * capitals.cast("long") > 3 * F.length(text).cast("long"),
            "D": text.rlike("[#$%&*|]")}


def failure_masks(docs: DataFrame, labels: DataFrame, failures: Mapping[str, Column], part: Column) -> DataFrame:
    """(part, mask, good, toxic, n): documents by their failures. Bit k of
    ``mask`` is the k-th of ``failures``, the bit after them ``COPY``."""
    bits = [F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(failures.values())]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask + b
    text = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    # rows of one text, id and part shrink to one; rows without an id are spread by their text
    rows = docs.select(F.col("doc_id").alias("id"), text.alias("text"), F.coalesce(part, F.lit("")).alias("part"), mask.alias("mask"))
    rows = rows.groupBy("id", "text", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumn("spread", F.when(F.col("id").isNull(), F.col("text")).otherwise(F.lit("")))
    marks = (labels.filter("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy(F.col("doc_id").alias("id"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).withColumn("spread", F.lit("")))
    first = rows.groupBy("text").agg(F.min("id").alias("id")).filter("id IS NOT NULL").withColumn("is_first", F.lit(True))
    # both keys: the rows of a text that a third of all have are spread by their ids
    known = rows.join(marks, ["id", "spread"], "left").join(first, ["text", "id"], "left")
    copy = F.when(F.col("is_first").isNull() & F.col("id").isNotNull(), F.lit(1 << len(bits))).otherwise(F.lit(0))
    known = known.select("part", (F.col("mask") + copy).alias("mask"), F.coalesce("good", F.lit(False)).alias("good"),
                         F.coalesce("toxic", F.lit(False)).alias("toxic"), "n")
    return known.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def removal_steps(masks: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """(mask, order): the step, from 1, that removes what has the mask's
    failures; one past the last step for none."""
    filters = orders.shape[1]
    fails = (masks[:, None] >> np.arange(filters)) & 1 == 1
    cost = np.where(fails, 0, filters + 1)
    position = np.argsort(orders, axis=1) + 1
    return np.minimum((cost[:, None, :] + position[None, :, :]).min(axis=2), filters + 1)


AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def _scatter(letters: str):
    orders = np.array(list(permutations(range(len(letters)))))
    names = ["".join(letters[f] for f in o) for o in orders]
    number, filters = orders.shape

    def run(counted: pd.DataFrame) -> pd.DataFrame:
        masks, n = counted["mask"].to_numpy(np.int64), counted["n"].to_numpy(np.int64)
        steps = removal_steps(masks, orders) - 1  # the last column is what stays

        def lost(weight: np.ndarray) -> np.ndarray:
            out = np.zeros((number, filters + 1), np.int64)
            np.add.at(out, (np.arange(number)[None, :], steps), weight[:, None])
            return out[:, :filters]

        removed = lost(n)
        fails = (masks[:, None] >> np.arange(filters)) & 1 == 1
        early = np.zeros((number, filters), np.int64)
        for s in range(filters):  # failing the filter of this step, gone before it
            early[:, s] = (fails[:, orders[:, s]] * (steps < s) * n[:, None]).sum(axis=0)
        alone = np.array([n[masks == 1 << f].sum() for f in range(filters)], np.int64)
        value = np.zeros(filters, np.int64)
        np.add.at(value, orders, removed)
        flat = orders.ravel()
        return pd.DataFrame({
            "part": counted["part"].iloc[0], "filter_order": np.repeat(names, filters),
            "step": np.tile(np.arange(1, filters + 1, dtype=np.int32), number),
            "kept": (n.sum() - np.cumsum(removed, axis=1)).ravel(), "removed": removed.ravel(), "redundant": early.ravel(),
            "unique_fails": alone[flat], "good_lost": lost(n * counted["good"].to_numpy(bool)).ravel(),
            "toxic_lost": lost(n * counted["toxic"].to_numpy(bool)).ravel(), "shapley": value[flat]})

    return run


def audit(docs: DataFrame, labels: DataFrame, failures: Mapping[str, Column] | None = None, part: str = "lang") -> DataFrame:
    """One row per part (value of the column ``part``; null: empty string),
    order of the filters and step: what is kept after it, removed in it,
    redundant, failing this filter only, good and toxic documents it loses, and
    its filter's removals over all orders.

    ``failures`` are filters by letter (default: ``text_failures``); ``COPY``
    follows them: a text that a row with a smaller ``doc_id`` has too, whatever
    became of that row. A null text is an empty one. Rows without an id are
    never copies, make none and have no labels; rows of one id are counted
    each, and aren't copies of each other. A document is good (toxic) if any row of
    ``labels`` with its id says so. An empty table has no parts, hence no rows.
    Columns of the input other than those named don't matter. At most 32 masks
    (with two labels) a part reach one task, however many documents there are.
    """
    failures = text_failures(F.col("text")) if failures is None else failures
    counted = failure_masks(docs, labels, failures, F.col(f"`{part}`"))
    return counted.groupBy("part").applyInPandas(_scatter("".join(failures) + COPY), AUDIT)
