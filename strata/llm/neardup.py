"""Near-duplicate documents by improved consistent weighted sampling.

A document is the multiset of its runs of five words. A run weighs its count
times a smoothed inverse document frequency. Frequencies are counted over all
documents in a hashed array of fixed size (runs that share a slot share its
count), so what tasks need to know is 8 MB at any scale. The smoothing keeps
weights within a factor of ``1 + IDF_SHARE``: plain inverse frequencies would
punish members of large groups, whose common runs are frequent just because the
group is large.

Improved consistent weighted sampling draws for each of ``HASHES`` hash functions
one (run, level) pair per document; two documents draw the same pair with the
probability of their weighted Jaccard similarity. Draws are banded. Documents
that share a band are first compared with its most central members (those that
share bands with many), which links the bulk of a group of any size; the ones
that stay apart from the band's largest group are compared with all of the band's
documents, in blocks and without emitting pairs. A link is a verified weighted
Jaccard similarity of ``LEAST`` or more; groups are connected components. Texts
of equal words are one class, compared once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import BLANKS, materialise
from strata.llm.components import components, spanning

RUN = 5
LEAST = 0.8
BANDS, BAND = 12, 4
HASHES = BANDS * BAND
#: Members of a band that all others are compared with first.
ANCHORS = 2
#: Documents and bytes of a block of queries, and of a block they are compared with.
QUERIES, TARGETS = (512, 2 << 20), (4096, 12 << 20)
IDF_SHARE = 0.25
SLOTS = 1 << 20
_PARTS = 64  # that the frequency array is summed up in
_TABLE = 1 << 12  # quantiles of a Gamma variate; draws need few, as b and the pair spread them
_U = np.uint64

_BLANK = np.zeros(256, bool)
_BLANK[np.frombuffer(BLANKS.encode(), np.uint8)] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: Odd, with their inverses modulo 2**64: a word's hash is a polynomial in the base.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U(base))
    out[0] = 1
    return np.multiply.accumulate(out)


_CHUNK = 1 << 16
_UP, _DOWN = _powers(_BASE, _CHUNK), _powers(_INVERSE, _CHUNK)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word ``[^\\x20\\x09-\\x0D]+``, in order. Long texts go
    through in chunks that end with a word; a longer word is a chunk of its own."""
    data = np.frombuffer(text, np.uint8)
    if len(data) > _CHUNK:
        gaps = np.flatnonzero(_BLANK[data])
        out, at = [], 0
        while at < len(data):
            end = at + _CHUNK
            if end < len(data):
                k = np.searchsorted(gaps, end) - 1
                if k >= 0 and gaps[k] >= at:
                    end = int(gaps[k]) + 1
                else:
                    k = np.searchsorted(gaps, end)
                    end = int(gaps[k]) + 1 if k < len(gaps) else len(data)
            out.append(_chunk(data[at:end]))
            at = end
        return np.concatenate(out)
    return _chunk(data)


def _chunk(data: np.ndarray) -> np.ndarray:
    inside = ~_BLANK[data]
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = (_UP, _DOWN) if len(data) <= _CHUNK else (_powers(_BASE, len(data)), _powers(_INVERSE, len(data)))
    total = np.concatenate([np.zeros(1, _U), np.cumsum((data.astype(_U) + _U(1)) * up[:len(data)])])
    return _mix((total[end] - total[start]) * down[start] + (end - start).astype(_U))


def runs(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the text's five-word runs, ascending, with their
    counts; fewer words than five are one run, no words none."""
    words = word_hashes(text)
    n = max(1, len(words) - RUN + 1) if len(words) else 0
    total = np.zeros(n, _U)
    for k in range(min(RUN, len(words))):
        total = _mix(total * _U(0xD1342543DE82EF95) + words[k:k + n])
    found, count = np.unique(total, return_counts=True)
    return found, count


def slot(run: np.ndarray) -> np.ndarray:
    return (run >> _U(44)).astype(np.int64)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, docs = np.zeros(SLOTS, np.int64), 0
    for batch in batches:
        found = [slot(runs(t)[0]) for t in batch.column(0).to_pylist()]
        docs += len(found)
        if found:
            total += np.bincount(np.concatenate(found), minlength=SLOTS)
    if docs:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(_PARTS), pa.int32()),
             pa.array([zlib.compress(x.tobytes(), 1) for x in total.reshape(_PARTS, -1)], pa.binary()),
             pa.array([docs] * _PARTS, pa.int64())], ["part", "counts", "docs"])


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(SLOTS // _PARTS, np.int64)
    for x in pdf["counts"]:
        total += np.frombuffer(zlib.decompress(x), np.int64)
    return pdf.iloc[:1].assign(counts=[total.tobytes()], docs=pdf["docs"].sum())


def idf(docs: DataFrame) -> np.ndarray:
    """The weight of one occurrence for each slot, 1 to 1 + IDF_SHARE (float32)."""
    texts = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    parts = texts.mapInArrow(_frequencies, "part int, counts binary, docs long").groupBy("part").applyInPandas(
        _summed, "part int, counts binary, docs long").toPandas().sort_values("part")
    if not len(parts):
        return np.ones(SLOTS, np.float32)
    count = np.concatenate([np.frombuffer(x, np.int64) for x in parts["counts"]])
    n = int(parts["docs"].iloc[0])
    rare = np.log((1 + n) / (1 + np.minimum(count, n))) / np.log(1 + max(n, 1))
    return (1 + IDF_SHARE * rare).astype(np.float32)


def _quantiles() -> tuple[np.ndarray, np.ndarray]:
    """Gamma(2, 1) variates and logs of such, at the middles of equal shares of probability."""
    p = (np.arange(_TABLE) + 0.5) / _TABLE
    low, high = np.zeros(_TABLE), np.full(_TABLE, 60.0)
    for _ in range(60):
        mid = (low + high) / 2
        under = 1 - np.exp(-mid) * (1 + mid) < p
        low, high = np.where(under, mid, low), np.where(under, high, mid)
    return high.astype(np.float32), np.log(high).astype(np.float32)


_GAMMA, _LOG_GAMMA = _quantiles()
_SEEDS = _mix(np.arange(1, HASHES // 2 + 1, dtype=_U) * _U(_BASE))
_ROWS = 1024


def draws(run: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The document's (run, level) draw under each hash function, as a hash.

    r and c are Gamma(2, 1), b uniform, all from a hash of run and function;
    level t = floor(log(weight) / r + b); the run of the least
    log(c) - r (t - b + 1) is drawn.
    """
    best = np.full(HASHES, np.inf, np.float32)
    out = np.zeros(HASHES, _U)
    log_weight = np.log(weight).astype(np.float32)
    for at in range(0, len(run), _ROWS):
        own, lw = run[at:at + _ROWS], log_weight[at:at + _ROWS]
        # 32 bits for each hash function, two from each 64-bit hash
        x = own[None, :] ^ _SEEDS[:, None]
        x ^= x >> _U(32)
        x *= _U(0xD6E8FEB86659FD93)
        x ^= x >> _U(32)
        x *= _U(0xD6E8FEB86659FD93)
        x ^= x >> _U(29)
        x = x.view(np.uint32).reshape(len(_SEEDS), len(own), 2).transpose(2, 0, 1).reshape(HASHES, len(own))
        r = _GAMMA[x & np.uint32(_TABLE - 1)]
        b = ((x >> np.uint32(12)) & np.uint32(255)).astype(np.float32)
        b += np.float32(0.5)
        b *= np.float32(1 / 256)
        t = np.floor(lw / r + b)
        a = _LOG_GAMMA[x >> np.uint32(20)]
        a -= r * (t - b + np.float32(1))
        k = a.argmin(1)
        rows = np.arange(HASHES)
        least = a[rows, k]
        drawn = _mix(own[k] + t[rows, k].astype(np.int64).view(_U) * _U(_INVERSE))
        better = least < best
        best[better], out[better] = least[better], drawn[better]
    return out


def _signatures(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            same, bands = [], []
            for text in batch.column(2).to_pylist():
                found, count = runs(text)
                if not len(found):
                    same.append(None)
                    bands.append(None)
                    continue
                drawn = draws(found, count * weights[slot(found)]).reshape(BANDS, BAND)
                band = np.arange(BANDS, dtype=_U)
                for k in range(BAND):
                    band = _mix(band * _U(_BASE) + drawn[:, k])
                words = _mix(found + _U(1)) * count.astype(_U)
                same.append(f"{len(found)}:{int(words.sum()):x}:{int(np.bitwise_xor.reduce(_mix(words))):x}")
                bands.append(band.view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(same, pa.string()), pa.array(bands, pa.list_(pa.int64()))],
                                             ["doc", "hash", "same", "bands"])

    return run


def similarity(a: bytes, b: bytes, weights: np.ndarray) -> float:
    """Weighted Jaccard similarity of two texts' runs."""
    (ra, ca), (rb, cb) = runs(a), runs(b)
    if not len(ra) or not len(rb):
        return 0.0
    _, ia, ib = np.intersect1d(ra, rb, assume_unique=True, return_indices=True)
    common = (np.minimum(ca[ia], cb[ib]) * weights[slot(ra[ia])]).sum(dtype=np.float64)
    total = (ca * weights[slot(ra)]).sum(dtype=np.float64) + (cb * weights[slot(rb)]).sum(dtype=np.float64)
    return float(common / (total - common))


def _verified(shared, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            sims = [similarity(a, b, weights) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([s >= least for s in sims], pa.bool_())],
                                             ["doc", "anchor", "near"])

    return run


def _features(texts: list[bytes], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, features and weights of texts: a run that occurs c times is c
    features, so common features weigh the lesser count. And each text's total."""
    rows, features, weight, total = [], [], [], np.zeros(len(texts))
    for k, text in enumerate(texts):
        found, count = runs(text)
        each = np.repeat(np.arange(len(found)), count)
        nth = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
        w = weights[slot(found)][each]
        rows.append(np.full(len(each), k))
        features.append(_mix(found[each] + nth.astype(_U) * _U(_BASE)))
        weight.append(w)
        total[k] = w.sum(dtype=np.float64)
    return np.concatenate(rows), np.concatenate(features), np.concatenate(weight), total


def similarities(left: list[bytes], right: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of each text in ``left`` with each in ``right``,
    from the features they have in common: common ones by matrix products, rare
    ones pair by pair."""
    row_a, feature_a, weight_a, total_a = _features(left, weights)
    row_b, feature_b, _, total_b = _features(right, weights)
    known, column_a = np.unique(feature_a, return_inverse=True)
    if not len(known) or not len(feature_b):
        return np.zeros((len(left), len(right)))
    column_b = np.minimum(np.searchsorted(known, feature_b), len(known) - 1)
    there = known[column_b] == feature_b
    row_b, column_b = row_b[there], column_b[there]
    weight = np.zeros(len(known), np.float64)
    weight[column_a] = weight_a
    number_a, number_b = np.bincount(column_a, minlength=len(known)), np.bincount(column_b, minlength=len(known))
    often = number_a * number_b > 4096
    common = np.zeros((len(left), len(right)))
    dense = np.flatnonzero(often)
    place = np.full(len(known), -1)
    for at in range(0, len(dense), 2048):
        own = dense[at:at + 2048]
        place[:] = -1
        place[own] = np.arange(len(own))
        a, b = np.zeros((len(left), len(own))), np.zeros((len(own), len(right)))
        keep = place[column_a] >= 0
        a[row_a[keep], place[column_a[keep]]] = weight[column_a[keep]]
        keep = place[column_b] >= 0
        b[place[column_b[keep]], row_b[keep]] = 1
        common += a @ b
    order = np.argsort(column_a, kind="stable")
    first = np.cumsum(number_a) - number_a
    rare = np.flatnonzero(~often[column_b])
    for at in range(0, len(rare), 1 << 18):
        own = rare[at:at + (1 << 18)]
        many = number_a[column_b[own]]
        each = np.repeat(own, many)
        nth = np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many)
        partner = row_a[order[first[column_b[each]] + nth]]
        common += np.bincount(partner * len(right) + row_b[each], weight[column_b[each]], common.size).reshape(common.shape)
    return common / np.maximum(total_a[:, None] + total_b[None, :] - common, 1e-12)


def _compared(shared, least: float):
    """Links that join documents of a block of queries and a block of all."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        if len(left) and len(right):
            near = similarities(left["text"].tolist(), right["text"].tolist(), shared.value) >= least
            a, b = np.nonzero(near)
            a, b = left["doc"].to_numpy()[a], right["doc"].to_numpy()[b]
            found = list(zip(*spanning(a[a != b], b[a != b]), strict=True))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return run


def _rest(open_rows: DataFrame, links: DataFrame, involved: DataFrame, shared, least: float) -> DataFrame:
    """Links of the documents that the anchors left apart: in each band those
    outside the band's largest group so far are compared with all of the band's,
    block by block. Only links that join something come out."""
    grouped = components(links)
    rows = open_rows.join(grouped, F.col("doc") == F.col("node"), "left").select(
        "band", "value", "doc", F.coalesce("component", "doc").alias("component"))
    rows = materialise(rows.join(involved.select("doc", F.length("text").alias("size")), "doc"), "near-rows")
    keys = ["band", "value"]
    largest = rows.groupBy(*keys, "component").agg(F.count("*").alias("n")).groupBy(*keys).agg(
        F.max(F.struct("n", "component"))["component"].alias("largest"), F.count("*").alias("groups"), F.sum("n").alias("total"))
    outside = F.col("component") != F.col("largest")
    # in a band of one more than the anchors every pair has been compared
    left_over = largest.where((F.col("groups") > 1) & (F.col("total") > ANCHORS + 1)).select(*keys, "largest")
    marked = rows.join(left_over, keys)

    def blocks(only, many: int, size: int):
        each = F.when(only, 1)
        return F.ceil(F.greatest(F.count(each) / many, F.sum(F.when(only, F.col("size")).otherwise(0)) / size)).cast("long")

    cut = marked.groupBy(*keys).agg(blocks(outside, *QUERIES).alias("is"), blocks(F.lit(True), *TARGETS).alias("js"))
    marked = materialise(marked.join(cut, keys).select(*keys, "doc", outside.alias("outside"), "is", "js"), "near-blocks")
    zero, hashed = F.lit(0).cast("long"), F.xxhash64("doc")
    queries = marked.where("outside").select(*keys, "doc", F.pmod(hashed, F.col("is")).alias("i"),
                                             F.explode(F.sequence(zero, F.col("js") - 1)).alias("j"))
    again = marked.select(*[F.col(c).alias(c) for c in marked.columns])
    targets = again.select(*keys, "doc", F.pmod(hashed, F.col("js")).alias("j"),
                           F.explode(F.sequence(zero, F.col("is") - 1)).alias("i"))
    place = [*keys, "i", "j"]
    left = queries.join(involved, "doc").select(*place, "doc", "text")
    copy = involved.select(F.col("doc").alias("d"), F.col("text").alias("text"))
    right = targets.join(copy, F.col("doc") == F.col("d")).select(*place, "doc", "text")
    return left.groupBy(*place).cogroup(right.groupBy(*place)).applyInPandas(_compared(shared, least), "a long, b long")


def groups(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """``doc_id``, ``class_id`` (least id of the documents with equal runs),
    ``component_id`` (least id of the group) and ``kept`` (whether it is the
    document's own), one row per id that isn't null.

    Null and empty texts and texts without words have no runs and stay alone. Rows
    that share an id are one document, whose text is the one of least hash, in whatever order
    the rows come. An empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    texts = texts.select("doc", F.xxhash64("text").alias("hash"), "text")
    weights = spark.sparkContext.broadcast(idf(docs))
    signed = texts.mapInArrow(_signatures(weights), "doc long, hash long, same string, bands array<long>")
    signed = materialise(signed, "near-signatures")
    single = signed.groupBy("doc").agg(F.min(F.struct("hash", "same", "bands")).alias("x")).select("doc", "x.hash", "x.same", "x.bands")
    classes = single.where("same IS NOT NULL").groupBy("same").agg(F.min("doc").alias("class_id"))
    members = materialise(single.join(classes, "same", "left").select(
        "doc", "hash", F.coalesce("class_id", "doc").alias("class_id"), "bands"), "near-classes")
    banded = members.where("doc = class_id AND bands IS NOT NULL").select(
        F.posexplode("bands").alias("band", "value"), "doc")
    sizes = banded.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    rows = banded.join(sizes, ["band", "value"])
    # documents that share bands with many stand near the middle of their group
    central = rows.groupBy("doc").agg(F.sum("n").alias("central"))
    open_rows = materialise(rows.join(central, "doc").select("band", "value", "doc", "central"), "near-bands")
    wanted = materialise(members.select("doc", "hash").join(open_rows.select("doc").distinct(), "doc", "left_semi"), "near-wanted")
    # shuffled at every size: this table grows with the corpus, so a broadcast would only be of use in small ones
    held = texts.join(wanted.hint("shuffle_hash"), ["doc", "hash"], "left_semi")
    involved = materialise(held.select("doc", "text").dropDuplicates(["doc"]), "near-texts")
    order = Window.partitionBy("band", "value").orderBy(F.desc("central"), "doc")
    anchors = (open_rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= ANCHORS)
               .select("band", "value", F.col("doc").alias("anchor")))
    pairs = open_rows.join(anchors, ["band", "value"]).where("doc != anchor").select(
        F.least("doc", "anchor").alias("doc"), F.greatest("doc", "anchor").alias("anchor")).distinct()
    others = involved.select(F.col("doc").alias("anchor"), F.col("text").alias("other"))
    checked = (pairs.join(involved, "doc").join(others, "anchor").select("doc", "anchor", "text", "other")
               .mapInArrow(_verified(weights, least), "doc long, anchor long, near boolean"))
    links = materialise(checked.where("near").select(F.col("doc").alias("a"), F.col("anchor").alias("b")), "near-links")
    links = links.union(_rest(open_rows.select("band", "value", "doc"), links, involved, weights, least))
    linked = components(links)
    out = members.join(linked, F.col("class_id") == F.col("node"), "left").select(
        F.col("doc").alias("doc_id"), "class_id", F.coalesce("component", "class_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group (the least id); rows without an
    id stay, repeated rows of a kept id too; same columns."""
    kept = groups(docs).where("kept").select(F.col("doc_id").alias("kept_id"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"))
    some = rows.where("id IS NOT NULL").join(kept, F.col("id") == F.col("kept_id"), "left_semi")
    return some.union(rows.where("id IS NULL")).select("row.*")
