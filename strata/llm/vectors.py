"""Near-duplicate vectors by sorted projection passes.

Equal vectors are one class, compared once. A pass hashes every class to 64 signs
of random projections, sorts by label and by the concatenated signs, and compares
each with its ``WINDOW`` next neighbours; verified pairs of all passes are united
to groups. Vectors are projected less their label's mean. The number of passes of a
label, of any size, follows from the window, its size, the wanted recall, and how
closely a sample of it lies together; a window that holds the whole label needs one.
No pass holds more than a window of rows at a time. Where a label lies so closely
that ``MOST`` passes don't reach the recall (whatever its size), it is compared
whole, block by block.

Passes carry a vector as bytes with the length of its rounding error, a quarter of
its size. Pairs that are similar by more than their errors are links; those that
the errors leave open are compared by the vectors themselves, joined back.

A window bounds a vector's partners, so links are counted apart and exactly, once
groups are known: all members within half the threshold's angle of the group's
least vector are linked with each other (angles obey the triangle inequality) and
need no comparison; the others are compared with the group's members in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise
from strata.llm.components import components, spanning

LEAST = 0.93
WINDOW = 64
RECALL = 0.9999
BLOCK = 1024
_BITS = 64
#: Classes of a label whose neighbourhood is measured.
SAMPLE = 1024
#: Passes beyond which a label is compared whole.
MOST = 4096


def passes(largest: int, least: float = LEAST, window: int = WINDOW, recall: float = RECALL) -> int:
    """So many that a pair at the threshold, in a label of ``largest`` classes,
    agrees in the signs that narrow the label down to a window in one pass at
    least, with the wanted probability."""
    same = 1 - math.acos(least) / math.pi
    hit = min(0.999, same ** math.log2(max(2.0, 2 * largest / window)))
    return max(2, math.ceil(math.log(1 - recall) / math.log(1 - hit)))


def _unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def measured_passes(x: np.ndarray, mean: np.ndarray, n: int, least: float, window: int, recall: float) -> int:
    """Passes for a label of ``n`` classes of which the unit vectors ``x`` are a
    sample, more than ``MOST`` if so many don't do. For each of them: the signs it takes until the classes
    that agree in all and aren't linked with it fill half a window at most, and the
    chance that a partner at the threshold agrees in as many."""
    apart = x - mean
    norm = np.maximum(np.linalg.norm(apart, axis=1), 1e-9)
    apart = apart / norm[:, None]
    agree = 1 - np.arccos(np.clip(apart @ apart.T, -1, 1)) / math.pi
    agree[x @ x.T >= least] = 0
    bits, power = np.full(len(x), _BITS), np.ones_like(agree)
    for b in range(1, _BITS):
        power *= agree
        bits = np.where((power.sum(axis=1) * n / len(x) <= window / 2) & (bits == _BITS), b, bits)
    same = 1 - np.arccos(np.clip(1 - (1 - least) / norm**2, -1, 1)) / math.pi
    hit = np.minimum(0.999, same**bits)
    number = 2
    while number <= MOST and ((1 - hit) ** number).mean() > 1 - recall:
        number += max(1, number // 50)
    return number


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of unit vectors of each (label, size) in a batch."""
    for batch in batches:
        frame = batch.to_pandas()
        out = [(label, size, len(own), _unit(own["vector"].tolist()).sum(axis=0)) for (label, size), own in frame.groupby(["label", "size"])]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int32()),
                                          pa.array([r[2] for r in out], pa.int64()), pa.array([r[3] for r in out], pa.list_(pa.float64()))],
                                         ["label", "size", "n", "sum"])


def _mean(frame: pd.DataFrame) -> pd.DataFrame:
    n = int(frame["n"].sum())
    return frame.head(1)[["label", "size"]].assign(n=n, mean=[(np.sum(frame["sum"].tolist(), axis=0) / n).tolist()])


def _planned(least: float, window: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        n = int(frame["n"].iloc[0])
        number = 1
        if n > window + 1:
            number = max(passes(n, least, window), measured_passes(
                _unit(frame["vector"].tolist()), np.array(frame["mean"].iloc[0]), n, least, window, RECALL))
        return frame.head(1)[["label", "size"]].assign(number=number if number <= MOST else 0)

    return run


def planned(each: DataFrame, least: float = LEAST, window: int = WINDOW) -> DataFrame:
    """(label, size, n, mean, number): the passes of each label; 0 of one that lies
    too closely for them."""
    sums = each.select("label", "size", "vector").mapInArrow(_sums, "label long, size int, n long, sum array<double>")
    means = materialise(sums.groupBy("label", "size").applyInPandas(_mean, "label long, size int, n long, mean array<double>"), "vector-means")
    sampled = each.select("label", "size", "id", "vector").join(means, ["label", "size"]).where(
        F.pmod(F.xxhash64("id"), F.col("n")) < SAMPLE).select("label", "size", "n", "mean", "vector")
    number = sampled.groupBy("label", "size").applyInPandas(_planned(least, window), "label long, size int, number int")
    # a label of which the sample holds nothing gets the passes of its size alone
    same = 1 - math.acos(least) / math.pi
    hit = F.least(F.lit(0.999), F.pow(F.lit(same), F.log2(F.greatest(F.lit(2.0), 2 * F.col("n") / window))))
    plain = F.greatest(F.lit(2), F.ceil(math.log(1 - RECALL) / F.log(1 - hit)).cast("int"))
    return materialise(means.join(number, ["label", "size"], "left").withColumn("number", F.coalesce("number", plain)), "vector-plan")


def _compared(least: float):
    """Links that join the rows of two blocks of a label, or of one."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        x, own, ids = _unit(frame["vector"].tolist()), frame["own"].to_numpy(), frame["id"].to_numpy()
        a, b = (np.flatnonzero(own == frame[c].iloc[0]) for c in ("low", "high"))
        near = np.zeros((len(x), len(x)), bool)
        near[np.ix_(a, b)] = x[a] @ x[b].T >= least
        near |= near.T
        left, right, new = [], [], np.ones(len(x), bool)
        for k in range(len(x)):
            todo = [k] if new[k] else []
            new[k] = False
            while todo:
                i = todo.pop()
                met = np.flatnonzero(near[i] & new)
                new[met] = False
                left.extend([ids[i]] * len(met))
                right.extend(ids[met])
                todo.extend(met.tolist())
        return pd.DataFrame({"id": np.array(left, np.int64), "other": np.array(right, np.int64)})

    return run


def block_links(each: DataFrame, least: float = LEAST) -> DataFrame:
    """(a, b) that join the classes of labels compared whole; ``each`` with ``n_label``."""
    blocks = F.ceil(F.col("n_label") / BLOCK).cast("long")
    dealt = each.select("label", "size", "id", "vector", F.pmod(F.xxhash64("id"), blocks).alias("own"),
                        F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("with"))
    keys = ["label", "size", "low", "high"]
    paired = dealt.withColumn("low", F.least("own", "with")).withColumn("high", F.greatest("own", "with")).drop("with")
    return paired.groupBy(*keys).applyInPandas(_compared(least), "id long, other long").toDF("a", "b")


def _rounded(x: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Unit vectors as signed bytes and a factor, and how far that is from them."""
    scale = (np.abs(x).max(axis=1) / 127).astype(np.float32)
    small = np.rint(x / scale[:, None].astype(np.float64)).clip(-127, 127).astype(np.int8)
    error = np.linalg.norm(x - small * scale[:, None].astype(np.float64), axis=1).astype(np.float32)
    return pa.array([r.tobytes() for r in small], pa.binary()), pa.array(scale), pa.array(error)


def _projected():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            size, number = batch.column("size").to_numpy(), batch.column("number").to_numpy()
            for d in np.unique(size).tolist():
                at = np.flatnonzero(size == d)
                at = at[np.argsort(-number[at], kind="stable")]
                own, many = batch.take(pa.array(at)), number[at]
                x = own.column("vector").flatten().to_numpy().reshape(-1, d).astype(np.float64)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                small, scale, error = _rounded(x)
                x = x - own.column("mean").flatten().to_numpy().reshape(-1, d)
                for p in range(int(many[0])):
                    if (d, p) not in planes:
                        planes[d, p] = np.random.default_rng([d, p]).standard_normal((d, _BITS))
                    rows = own.slice(0, int((many > p).sum()))
                    keys = np.packbits(x[:len(rows)] @ planes[d, p] > 0, axis=1).view(">u8")[:, 0]
                    keys = (keys.astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)  # signed, in the same order
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), p, np.int32)), rows.column("label"), rows.column("size"), pa.array(keys),
                         rows.column("id"), *(c.slice(0, len(rows)) for c in (small, scale, error))],
                        ["pass", "label", "size", "key", "id", "small", "scale", "error"])

    return run


#: Beyond the errors of a pair: what single precision of them may hide.
_SLACK = 1e-6


def _near(group: np.ndarray, x: np.ndarray, error: np.ndarray, least: float, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows at most ``window`` apart, of one group, that are similar, or
    may be by their rounding errors; and which of them surely are."""
    left, right, sure = [], [], []
    for step in range(1, min(window, len(x) - 1) + 1):
        same = np.flatnonzero(group[:-step] == group[step:])
        if len(same):
            dot = np.einsum("ij,ij->i", x[same], x[same + step])
            a, b = error[same], error[same + step]
            off = a + b + a * b + _SLACK
            hit = dot + off >= least
            left.append(same[hit])
            right.append(same[hit] + step)
            sure.append((dot - off >= least)[hit])
    none = np.zeros(0, np.int64)
    return np.concatenate(left or [none]), np.concatenate(right or [none]), np.concatenate(sure or [np.zeros(0, bool)])


def _grouped(frame: pd.DataFrame) -> np.ndarray:
    """A number for each change of (pass, label, size) along sorted rows."""
    keys = frame[["pass", "label", "size"]]
    return (keys != keys.shift()).any(axis=1).cumsum().to_numpy()


_ROW = ("seam int, late boolean, at int, pass int, label long, size int, id long, small binary, scale float, error float, "
        "other long, sure boolean")


def _pairs(frame: pd.DataFrame, least: float, window: int) -> list[tuple[int, int, bool]]:
    group, ids, out = _grouped(frame), frame["id"].to_numpy(), []
    # vectors of one size lie together; other sizes are other groups
    for size in frame["size"].unique():
        own = np.flatnonzero((frame["size"] == size).to_numpy())
        small = np.frombuffer(b"".join(frame["small"].iloc[own]), np.int8).reshape(len(own), -1)
        x = small * frame["scale"].iloc[own].to_numpy(np.float64)[:, None]
        a, b, sure = _near(group[own], x, frame["error"].iloc[own].to_numpy(np.float64), least, window)
        a, b = ids[own[a]], ids[own[b]]
        out.extend((i, k, True) for i, k in zip(*spanning(a[sure], b[sure]), strict=True))
        out.extend((i, k, False) for i, k in zip(a[~sure].tolist(), b[~sure].tolist(), strict=True))
    return out


def _windows(least: float, window: int):
    columns = ["seam", "late", "at", "pass", "label", "size", "id", "small", "scale", "error", "other", "sure"]

    def filled(frame: pd.DataFrame) -> pd.DataFrame:
        for c in columns:
            if c not in frame:
                frame[c] = pd.Series([None] * len(frame), dtype=object, index=frame.index)
        return frame[columns]

    def links(pairs: list[tuple[int, int, bool]]) -> pd.DataFrame:
        return filled(pd.DataFrame(pairs, columns=["id", "other", "sure"]))

    def edge(rows: pd.DataFrame, seam: int, late: bool) -> pd.DataFrame:
        return filled(rows.assign(seam=seam, late=late, at=range(len(rows))))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, last, head = TaskContext.get().partitionId(), None, None
        for frame in frames:
            if not len(frame):
                continue
            if head is None or len(head) < window:
                head = frame.head(window) if head is None else pd.concat([head, frame.head(window - len(head))])
            both = frame if last is None else pd.concat([last, frame])
            if pairs := _pairs(both, least, window):
                yield links(pairs)
            last = both.tail(window)
        if head is not None:
            yield edge(head, task - 1, True)
            yield edge(last, task, False)

    return run


def _seam(least: float, window: int):
    """Pairs across the border of two neighbouring partitions."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["late", "at"])
        found = pd.DataFrame(_pairs(frame, least, window), columns=["id", "other", "sure"])
        return found.astype({"id": "int64", "other": "int64", "sure": "bool"})

    return run


def classes(rows: DataFrame) -> DataFrame:
    """(label, size, vector, id, n) of the distinct usable vectors: not null, not
    zero, all components finite; ``id`` the least of its ``n`` vectors."""
    good = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = good & F.exists("embedding", lambda x: x != 0) & F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    usable = rows.where(F.coalesce(good, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<float>").alias("vector"))
    each = usable.groupBy("label", "vector").agg(F.min("id").alias("id"), F.count_distinct("id").alias("n"))
    return each.select("label", F.size("vector").alias("size"), "vector", "id", "n")


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def _cosine(a: str, b: str) -> Column:
    return _dot(a, b) / (F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))


def window_links(each: DataFrame, least: float = LEAST, window: int = WINDOW) -> DataFrame:
    """(a, b) of verified pairs that join classes to groups, from all passes and
    from the labels that lie too closely for passes."""
    plan = planned(each, least, window).withColumnRenamed("n", "n_label")
    rows = each.select("label", "size", "id", "vector").join(plan, ["label", "size"])
    whole = block_links(rows.where("number = 0"), least)
    order = ["pass", "label", "size", "key", "id"]
    kept = ["small", "scale", "error"]
    hashed = rows.where("number > 0").select("label", "size", "id", "vector", "mean", "number").mapInArrow(
        _projected(), "pass int, label long, size int, key long, id long, small binary, scale float, error float")
    swept = hashed.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "pass", "label", "size", "id", *kept).mapInPandas(_windows(least, window), _ROW)
    swept = materialise(swept, "vector-windows")
    across = swept.where("seam IS NOT NULL").groupBy("seam").applyInPandas(_seam(least, window), "id long, other long, sure boolean")
    found = materialise(swept.where("other IS NOT NULL").select("id", "other", "sure").union(across), "vector-pairs")
    left_open = found.where("NOT sure").select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
    first = each.select(F.col("id").alias("a"), F.col("vector").alias("x"))
    second = each.select(F.col("id").alias("b"), F.col("vector").alias("y"))
    closed = left_open.join(first, "a").join(second, "b").where(_cosine("x", "y") >= least).select("a", "b")
    return found.where("sure").select("id", "other").toDF("a", "b").union(closed).union(whole)


def _linked(least: float):
    """Links between a block of members outside the core and a block of all."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"id": np.zeros(0, np.int64), "links": np.zeros(0, np.int64)})
        a, b = left["id"].to_numpy(), right["id"].to_numpy()
        near = _unit(left["vector"].tolist()) @ _unit(right["vector"].tolist()).T >= least
        near &= a[:, None] != b[None, :]
        core = right["core"].to_numpy()
        return pd.DataFrame({"id": np.concatenate([a, b[core]]), "links": np.concatenate(
            [near @ right["n"].to_numpy(), left["n"].to_numpy() @ near[:, core]])})

    return run


def count_links(each: DataFrame, grouped: DataFrame, least: float = LEAST) -> DataFrame:
    """(id, links) of the classes in ``grouped`` (node, component): how many
    vectors, its own copies included, each is linked with."""
    members = each.join(grouped, F.col("id") == F.col("node")).select("component", "id", "n", "size", "vector")
    pivot = members.where("id = component").select(F.col("component").alias("c"), F.col("vector").alias("pivot"))
    # half the angle, and a little less against rounding
    close = math.cos(math.acos(least) / 2) + 1e-9
    members = members.join(pivot, F.col("component") == F.col("c")).select(
        "component", "id", "n", "vector", (_cosine("vector", "pivot") >= close).alias("core"))
    members = materialise(members, "vector-members")
    sums = members.groupBy("component").agg(
        F.sum(F.when(F.col("core"), F.col("n")).otherwise(0)).alias("core_n"),
        F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"),
        F.ceil(F.count(F.when(~F.col("core"), 1)) / BLOCK).cast("long").alias("outer"))
    sized = members.join(sums, "component")
    own = sized.select("id", (F.when(F.col("core"), F.col("core_n")).otherwise(F.col("n")) - 1).alias("links"))
    some = sized.where("outer > 0")
    zero = F.lit(0).cast("long")
    left = some.where("NOT core").select(
        "component", "id", "n", "vector", F.pmod(F.xxhash64("id"), F.col("outer")).alias("i"),
        F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("j"))
    again = some.select(*[F.col(c).alias(c) for c in some.columns])  # columns of its own
    right = again.select(
        "component", "id", "n", "vector", "core", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("j"),
        F.explode(F.sequence(zero, F.col("outer") - 1)).alias("i"))
    keys = ["component", "i", "j"]
    compared = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_linked(least), "id long, links long")
    return own.union(compared).groupBy("id").agg(F.sum("links").alias("links"))


def near_duplicates(rows: DataFrame, least: float = LEAST, window: int = WINDOW) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of
    ``rows`` (vec_id, embedding, label).

    Vectors are compared if labels (and lengths) are equal and not null. A null,
    empty or zero vector and one with a null or non-finite component link with
    nothing and stay alone; a row without ``vec_id`` gets no component and isn't
    kept. Rows that repeat id and vector are one vector. An empty table gives no rows.
    """
    each = materialise(classes(rows), "vector-classes")
    grouped = materialise(components(window_links(each, least, window)), "vector-groups")
    counted = count_links(each, grouped, least)
    found = each.join(grouped, F.col("id") == F.col("node"), "left").join(counted, "id", "left").select(
        F.col("label").alias("l"), F.col("vector").alias("v"), F.coalesce("component", "id").alias("component"),
        F.coalesce("links", F.col("n") - 1).alias("links"))
    given = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                        F.col("embedding").cast("array<float>").alias("vector"))
    met = given.join(found, (F.col("label") == F.col("l")) & (F.col("vector") == F.col("v")), "left")
    own = met.select("vec_id", F.when(F.col("vec_id").isNull(), F.lit(0)).otherwise(F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
                     F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id")).alias("component_id"))
    return own.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
