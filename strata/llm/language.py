"""Language identification by prediction by partial matching (PPM).

For every language a variable-order byte context tree (orders 3, 2, 1, 0 and
the uniform order -1) is learned from a bounded sample of labelled rows. The
counts are then frozen. A byte's code length under a language is exact PPM with
escape method C and no exclusions: in a context seen ``n`` times with ``d``
distinct followers a follower seen ``c`` times costs ``log2((n+d)/c)`` bits, any
other byte pays the escape ``log2((n+d)/d)`` and is coded one order lower; an
unseen context costs nothing and passes on. The language with the shortest code
for the whole text wins.

The tree is held as arrays: a dense table takes three byte classes to the node
of that context, a second one takes (node, next byte class) to a row of costs,
one column per language. A text is scored with array operations over the whole
batch, so the work is a few table lookups per byte whatever the text's length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.llm.common import slices

ORDER = 3
#: Stands before every text, so that each byte has a full context.
START = b"\n" * ORDER
UNDETERMINED = "und"
_SLICE = 1 << 19


@dataclass
class LanguageModel:
    """Frozen statistics of all languages; its size follows the bounded sample."""

    languages: list[str]
    byte_class: np.ndarray  # 256 -> class; bytes not seen in training share one
    node: np.ndarray  # class triple -> context node or -1
    child: np.ndarray  # (context node, class) -> row of ``cost3`` or -1
    cost3: np.ndarray  # cost of a byte seen after its three bytes in some language
    escape3: np.ndarray  # cost of leaving a context node
    cost2: np.ndarray  # cost of a node's last byte after the two before it
    escape2: np.ndarray  # (class pair) cost of leaving it
    cost1: np.ndarray  # (class pair) cost of the second after the first


def _frozen(count: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Costs of (context, byte) and of the escape from the counts of one
    language, contexts by row; ``lower`` is the cost one order lower."""
    n = count.sum(-1, keepdims=True)
    d = (count > 0).sum(-1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        escape = np.where(n > 0, np.log2((n + d) / d), 0.0)
        cost = np.where(count > 0, np.log2((n + d) / count), escape + lower)
    return cost, escape[..., 0]


def build(languages: list[str], lang: np.ndarray, code: np.ndarray, count: np.ndarray) -> LanguageModel:
    """The model from counts of four-byte windows per language (by position in
    ``languages``)."""
    four = np.stack([(code >> s) & 255 for s in (24, 16, 8, 0)], 1).astype(np.int64)
    seen = np.unique(four)
    classes = len(seen) + 1  # the last one: bytes never seen
    byte_class = np.full(256, classes - 1, np.int64)
    byte_class[seen] = np.arange(len(seen))
    c = byte_class[four]
    last = (c[:, 1] * classes + c[:, 2]) * classes + c[:, 3]
    first = (c[:, 0] * classes + c[:, 1]) * classes + c[:, 2]
    triples = np.unique(np.concatenate([first, last]))
    node = np.full(classes**3, -1, np.int32)
    node[triples] = np.arange(len(triples))
    pairs4, row4 = np.unique(node[first].astype(np.int64) * classes + c[:, 3], return_inverse=True)
    size = len(languages)
    cost3 = np.empty((len(pairs4), size), np.float32)
    escape3 = np.zeros((len(triples), size), np.float32)
    cost2 = np.empty((len(triples), size), np.float32)
    escape2 = np.zeros((classes * classes, size), np.float32)
    cost1 = np.empty((classes * classes, size), np.float32)
    for k in range(size):
        own = lang == k
        order0 = np.bincount(c[own, 3], count[own], classes)
        order1 = np.bincount(c[own, 2] * classes + c[own, 3], count[own], classes**2).reshape(classes, classes)
        low0, _ = _frozen(order0[None, :], np.full((1, classes), 8.0))
        low1, _ = _frozen(order1, np.broadcast_to(low0, order1.shape))
        cost1[:, k] = low1.ravel()
        # order 2: nodes hold the triples seen in any language
        two = np.bincount(node[last[own]], count[own], len(triples))
        pair = triples // classes
        n2 = np.bincount(pair, two, classes**2)
        d2 = np.bincount(pair, two > 0, classes**2)
        with np.errstate(divide="ignore", invalid="ignore"):
            e2 = np.where(n2 > 0, np.log2((n2 + d2) / d2), 0.0)
            seen2 = np.log2((n2 + d2)[pair] / two)
        escape2[:, k] = e2
        cost2[:, k] = np.where(two > 0, seen2, e2[pair] + low1.ravel()[triples % classes**2])
        # order 3
        three = np.bincount(row4[own], count[own], len(pairs4))
        context = pairs4 // classes
        n3 = np.bincount(context, three, len(triples))
        d3 = np.bincount(context, three > 0, len(triples))
        below = node[(triples[context] % classes**2) * classes + pairs4 % classes]
        with np.errstate(divide="ignore", invalid="ignore"):
            e3 = np.where(n3 > 0, np.log2((n3 + d3) / d3), 0.0)
            seen3 = np.log2((n3 + d3)[context] / three)
        escape3[:, k] = e3
        cost3[:, k] = np.where(three > 0, seen3, e3[context] + cost2[below, k])
    child = np.full(len(triples) * classes, -1, np.int32)
    child[pairs4] = np.arange(len(pairs4))
    return LanguageModel(languages, byte_class.astype(np.int32), node, child, cost3, escape3, cost2, escape2, cost1)


def code_lengths(model: LanguageModel, texts: list[bytes]) -> np.ndarray:
    """Bits of every text under every language."""
    classes = int(model.byte_class.max()) + 1
    data = np.frombuffer(START + START.join(texts), np.uint8)
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    start = np.cumsum(length + ORDER) - length
    bounds = np.stack([start, start + length], 1).ravel()
    total = np.zeros((len(texts), len(model.languages)))
    for p in range(ORDER, len(data), _SLICE):
        q = min(p + _SLICE, len(data))
        c = model.byte_class[data[p - ORDER:q]]
        context = (c[:-3] * classes + c[1:-2]) * classes + c[2:-1]
        node = model.node[context]
        row = model.child[node * classes + c[3:]]
        row[node < 0] = -1
        cost = model.cost3[row]
        miss = np.flatnonzero(row < 0)
        if len(miss):
            lower = context[miss] % classes**2 * classes + c[3:][miss]
            here, low = node[miss], model.node[lower]
            rest = np.where((low >= 0)[:, None], model.cost2[low],
                            model.escape2[lower // classes] + model.cost1[lower % classes**2])
            cost[miss] = rest + np.where((here >= 0)[:, None], model.escape3[here], 0)
        cut = np.unique(np.concatenate([[p], bounds[(bounds > p) & (bounds < q)]]))
        part = np.add.reduceat(cost, cut - p, axis=0, dtype=np.float64)
        segment = np.searchsorted(bounds, cut, "right") - 1
        inside = (segment >= 0) & (segment % 2 == 0)
        np.add.at(total, segment[inside] // 2, part[inside])
    return total


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = np.frombuffer(START + text, np.uint8).astype(np.int64)
            code, count = np.unique((data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:],
                                    return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(code), pa.string()), pa.array(code), pa.array(count)], ["lang", "code", "n"])


def fit(labelled: DataFrame, key: Column, sample_bytes: int = 8 << 20, sample_rows: int = 1000,
        max_languages: int = 128) -> LanguageModel:
    """Learns from rows (``text``, ``lang``) of ``labelled``.

    The sample is bounded: at most ``sample_rows`` rows per language in the
    order of ``key``'s hash, as long as their bytes stay within the language's
    equal share of ``sample_bytes``; of more than ``max_languages`` labels the
    most frequent are learned. Hence at most ``sample_bytes`` distinct windows
    reach the driver. Rows whose text or label is null or empty teach nothing;
    without any row the model knows no language.
    """
    rows = labelled.select(F.col("lang").alias("lang"), F.col("text").alias("text"), F.xxhash64(key).alias("h"))
    rows = rows.where("lang IS NOT NULL AND octet_length(text) > 0")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    if not sizes:
        return build([], *[np.zeros(0, np.int64)] * 3)
    share = sample_bytes // len(sizes)
    # thin the rows before ranking them; four times the rows that are needed
    rate = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, 4 * sample_rows / r["n"]))])
    thin = rows.where(((F.col("h").bitwiseAND(F.lit((1 << 30) - 1))) / F.lit(float(1 << 30))) < rate[F.col("lang")])
    ranked = (thin.where(F.octet_length("text") <= share)
              .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text")))
              .where(F.col("place") <= sample_rows)
              .withColumn("bytes", F.sum(F.octet_length("text")).over(
                  Window.partitionBy("lang").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)))
              .where(F.col("bytes") <= share))
    counts = (ranked.select("lang", F.col("text").cast("binary").alias("text"))
              .mapInArrow(_windows, "lang string, code long, n long")
              .groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow())
    names = sorted(set(counts["lang"].to_pylist()), key=lambda x: x.encode())
    place = {x: i for i, x in enumerate(names)}
    return build(names, np.array([place[x] for x in counts["lang"].to_pylist()], np.int64),
                 counts["code"].to_numpy().astype(np.int64), counts["n"].to_numpy().astype(np.float64))


RESULT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()),
                       T.StructField("bits", T.DoubleType())])


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Adds ``lang_pred``, ``score`` (posterior of the winner under equal
    priors, 0 to 1) and ``bits_per_byte`` (of the winner) to every row.

    A text that is null or has no letter is ``und`` with score 0 and null bits,
    and so is every text when no language was learned. Equal code lengths go to
    the first language by code point. Columns of these names give way; all
    others, rows and repeats stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        frozen = shared.value
        for array in (whole.slice(*part) for whole in texts for part in (slices(whole) if len(whole) else [(0, 0)])):
            values = array.to_pylist()
            place = [i for i, x in enumerate(values) if x]
            lang, score, bits = [UNDETERMINED] * len(values), [0.0] * len(values), [None] * len(values)
            if place and frozen.languages:
                total = code_lengths(frozen, [values[i] for i in place])
                best = total.argmin(1)
                least = total[np.arange(len(best)), best]
                odds = 1 / np.exp2(least[:, None] - total).sum(1)
                for i, b, s, least_bits in zip(place, best.tolist(), odds.tolist(), least.tolist(), strict=True):
                    lang[i], score[i], bits[i] = frozen.languages[b], s, least_bits / len(values[i])
            yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(bits, pa.float64())], ["lang", "score", "bits"])

    # texts without a letter need no scoring
    spelled = F.when(F.col("text").rlike(r"\p{L}"), F.col("text").cast("binary"))
    found = docs.select(F.struct("*").alias("row"), scored(spelled).alias("found"))
    out = found.select("row", F.col("found.lang").alias("p"), F.col("found.score").alias("s"),
                       F.col("found.bits").alias("b"))
    taken = {"lang_pred", "score", "bits_per_byte"}
    return out.select(*[F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in taken],
                      F.col("p").alias("lang_pred"), F.col("s").alias("score"), F.col("b").alias("bits_per_byte"))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 4, is 2 (a null id is never held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned(docs: DataFrame) -> LanguageModel:
    """The model learned from the rows of ``docs`` that aren't held out."""
    return fit(docs.where(~held_out(F.col("doc_id"))), F.col("doc_id"))


def accepted(docs: DataFrame, most_bits: float = 8.0) -> DataFrame:
    """The rows with a determined language whose text the winning model codes in
    fewer than ``most_bits`` bits a byte (what a uniform code takes), so that
    no language explains the dropped ones; same columns."""
    marked = identify(docs.select(F.struct("*").alias("whole"), "text"), learned(docs))
    return marked.where((F.col("lang_pred") != UNDETERMINED) & (F.col("bits_per_byte") < most_bits)).select("whole.*")
