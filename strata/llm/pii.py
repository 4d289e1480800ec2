"""Personal data: exact base patterns, and terms that give protected entities away.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers.
Each is a protected entity. Terms (words) within ``AROUND`` words of an entity
are its context; over the whole corpus, the co-occurrence of a term t and an
entity e estimates what t reveals: p(e | t) = occurrences of t near e over all
occurrences of t, and log2(p(e | t) / p(e)) bits of information, all counted over
the same words: those outside base spans, which end at a span's border. A term discloses
an entity if p(e | t) reaches ``LEAST_SHARE``, the information ``LEAST_BITS``,
and at least ``LEAST_CONTEXTS`` different windows support it (copies of a
document are one window). Such terms become spans of their own wherever they
stand, near the entity or not and in documents without base spans too; in the
sanitised text they are generalised to their kind, or removed where they
determine the entity almost surely.

The disclosing terms are joined back to the words of all texts. A table of
``SLOTS`` bytes keeps words that are surely none of them out of that join, and
tells over how many salts a frequent one is spread; it bounds what a task holds,
and terms that share a slot cost rows, not results.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import materialise

KINDS = ("email", "ip", "card", "phone", "term")
AROUND = 8
LEAST_SHARE = 0.5
LEAST_BITS = 8.0
LEAST_CONTEXTS = 3
#: From this share on a term is removed instead of generalised.
SURE = 0.9
#: Slots of the table of disclosing terms, and occurrences that one salt gets.
SLOTS = 1 << 23
SALT_WORDS = 100_000
_CHUNK = 1 << 16

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Digits are taken whole (++), and an address begins where a run of digits does,
# which is what the leftmost longest match does; so long runs cost no retries.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_DIGIT = re.compile(r"[0-9]")
_EDGES = ".,;:!?\"'()[]{}<>|#*$%&"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from their @."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            free = m.end()
            yield start, free
        at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, sorted; kind is a place in ``KINDS``."""
    out = [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_DIGIT.findall(m.group())) <= 15]
    return sorted(out)


def term_of(word: str) -> str:
    """A word without marks at its ends, in lower case."""
    return word.strip(_EDGES).lower()


def words_apart(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of all words outside the spans, which words end at."""
    at = 0
    for start, _, end in [*spans, (len(text), 0, len(text))]:
        for m in _WORD.finditer(text, at, max(at, start)):
            if term := term_of(m.group()):
                first = m.start() + len(m.group()) - len(m.group().lstrip(_EDGES))
                yield term, first, first + len(m.group().strip(_EDGES))
        at = max(at, end)


def contexts(text: str, spans: list[tuple[int, int, int]]) -> list[dict]:
    """Terms among the ``AROUND`` words before and after each span, of the words
    outside spans: term, entity and window (as hashes). An occurrence counts once
    for an entity, also near two spans of it; its window is that of the first."""
    words = list(words_apart(text, spans))
    starts = [start for _, start, _ in words]
    out, met = [], set()
    for start, kind, end in spans:
        before, after = bisect_left(starts, start), bisect_left(starts, end)
        near = [*range(max(0, before - AROUND), before), *range(after, min(len(words), after + AROUND))]
        entity = xxhash.xxh3_64_intdigest(f"{kind}:{text[start:end].lower()}") - 2**63
        window = xxhash.xxh3_64_intdigest(" ".join(words[k][0] for k in near)) - 2**63
        for k in near:
            if (k, entity) not in met:
                met.add((k, entity))
                out.append({"term": words[k][0], "entity": entity, "around": window})
    return out


_SPAN = "struct<start:int,kind:int,end:int>"
_FOUND = f"doc_id long, hash long, spans array<{_SPAN}>, terms array<struct<term:string,entity:long,around:long>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    term = pa.struct([("term", pa.string()), ("entity", pa.int64()), ("around", pa.int64())])
    for batch in batches:
        spans, terms = [], []
        for text in batch.column(2).to_pylist():
            found = base_spans(text) if text else []
            spans.append([{"start": s, "kind": k, "end": e} for s, k, e in found])
            terms.append(contexts(text, found) if found else [])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, pa.list_(span)), pa.array(terms, pa.list_(term))],
                                         ["doc_id", "hash", "spans", "terms"])


def _outside(text: str, spans: list[tuple[int, int, int]]) -> list[bytes]:
    """The words outside the spans, which words end at."""
    parts, at = [], 0
    for start, _, end in spans:
        parts.append(text[at:max(at, start)])
        at = max(at, end)
    return " ".join([*parts, text[at:]]).encode("utf-8", "replace").split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of terms outside base spans, and words there in all (the empty term)."""
    total: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            total.update(_outside(text, base_spans(text)))
        if len(total) > 200_000:
            yield _terms(total)
            total.clear()
    if total:
        yield _terms(total)


def _terms(words: Counter) -> pa.RecordBatch:
    out: Counter = Counter()
    for word, n in words.items():
        out[term_of(word.decode("utf-8", "replace"))] += n
    out[""] = sum(words.values())
    return pa.RecordBatch.from_arrays([pa.array(list(out), pa.string()), pa.array(list(out.values()), pa.int64())], ["term", "n"])


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def scan(docs: DataFrame) -> DataFrame:
    """Base spans and context terms of every row; the hash tells texts of one id apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text")).alias("hash"),
                       F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_scan, _FOUND)


def disclosing(docs: DataFrame, scanned: DataFrame) -> DataFrame:
    """(term, entity, n, share, bits) of the terms that give an entity away; ``n``
    is how often the term occurs outside base spans. What is near an entity is part
    of what is counted, so no share exceeds 1."""
    near = scanned.select(F.explode("terms").alias("x")).select("x.term", "x.entity", "x.around")
    windows = near.groupBy("term", "entity", "around").agg(F.count("*").alias("n"))
    pairs = windows.groupBy("term", "entity").agg(F.sum("n").alias("both"), F.count("*").alias("windows"))
    pairs = pairs.where(F.col("windows") >= LEAST_CONTEXTS)
    entities = scanned.select(F.explode("terms").alias("x")).groupBy(F.col("x.entity").alias("e")).agg(F.count("*").alias("words_near"))
    counts = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        _counted, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = materialise(counts, "term-counts")
    words = counts.where("term = ''").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    total = max(1, words.first()[0])
    met = pairs.join(counts.where("term != ''").withColumnRenamed("term", "t"), F.col("term") == F.col("t")).join(
        entities, F.col("entity") == F.col("e"))
    share = F.col("both") / F.col("n")
    met = met.select("term", "entity", "n", share.alias("share"), F.log2(share / (F.col("words_near") / F.lit(float(total)))).alias("bits"))
    return met.where((F.col("share") >= LEAST_SHARE) & (F.col("bits") >= LEAST_BITS))


def slot_of(term: str) -> int:
    """The slot of a term; Spark's ``pmod(xxhash64(term), SLOTS)``."""
    return xxhash.xxh64_intdigest(term.encode("utf-8", "replace"), 42) % SLOTS


def _levels(pdf: pd.DataFrame) -> pd.DataFrame:
    levels = np.zeros(_CHUNK, np.uint8)
    np.maximum.at(levels, pdf["slot"].to_numpy() % _CHUNK, pdf["level"].to_numpy().astype(np.uint8))
    return pd.DataFrame({"chunk": [pdf["slot"].iloc[0] // _CHUNK], "levels": [levels.tobytes()]})


def _located(levels):
    """Places of the words whose slot is taken, a row for each term of a text."""
    row = pa.struct([("term", pa.string()), ("salt", pa.int64()), ("places", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = levels.value
        taken: dict[bytes, bool] = {}  # of words; bounded
        for batch in batches:
            at, rows = [], []
            for k, (key, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                places: dict[str, list] = {}
                spans = base_spans(text)
                words = set(_outside(text, spans))
                if len(taken) > 200_000:
                    taken.clear()
                for word in words.difference(taken):
                    term = term_of(word.decode("utf-8", "replace"))
                    taken[word] = bool(term and table[slot_of(term)])
                if not any(map(taken.__getitem__, words)):
                    continue
                for term, start, end in words_apart(text, spans):
                    places.setdefault(term, []).append({"start": start, "end": end})
                for term, own in places.items():
                    if level := table[slot_of(term)]:
                        at.append(k)
                        rows.append({"term": term, "salt": key % (1 << (level - 1)), "places": own})
            found = pa.array(rows, row)
            yield pa.RecordBatch.from_arrays([c.take(pa.array(at, pa.int64())) for c in batch.columns[:2]] + found.flatten(),
                                             ["d", "h", "term", "salt", "places"])

    return run


def _located_terms(docs: DataFrame, terms: DataFrame) -> DataFrame | None:
    """(d, h, term, places, share) of all occurrences of ``terms`` (term, n, share);
    None if there are no terms."""
    # level 1 is one salt, each further level twice as many
    level = 1 + F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("n") / SALT_WORDS))).cast("int")
    dealt = materialise(terms.select("term", "share", F.pmod(F.xxhash64("term"), F.lit(SLOTS)).alias("slot"), level.alias("level")), "pii-terms")
    chunks = dealt.groupBy(F.floor(F.col("slot") / _CHUNK)).applyInPandas(_levels, "chunk long, levels binary").collect()
    if not chunks:
        return None
    table = bytearray(SLOTS)
    for r in chunks:
        table[r.chunk * _CHUNK:(r.chunk + 1) * _CHUNK] = r.levels
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text")).alias("hash"), F.coalesce("text", F.lit("")).alias("text"))
    words = rows.mapInArrow(_located(spark.sparkContext.broadcast(bytes(table))),
                            "d long, h long, term string, salt long, places array<struct<start:int,end:int>>")
    # terms of one slot are spread alike
    slots = dealt.groupBy("slot").agg(F.max("level").alias("level"))
    spread = dealt.drop("level").join(slots, "slot").select(
        F.col("term").alias("t"), "share", F.explode(F.sequence(F.lit(0).cast("long"), F.pow(F.lit(2.0), F.col("level") - 1).cast("long") - 1)).alias("s"))
    met = words.join(spread, (F.col("term") == F.col("t")) & (F.col("salt") == F.col("s")))
    return met.groupBy("d", "h", "term").agg(F.first("places").alias("places"), F.first("share").alias("share"))  # copies of a row are alike


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``hash`` (of the text) and ``spans``: base and term spans with
    ``share`` (null of base spans), sorted by start, then kind; one row per row.
    Every occurrence of a disclosing term outside base spans is a span.

    A null or empty text has no spans. Rows that repeat an id with another text are
    told apart by the hash. No documents give no rows.
    """
    scanned = materialise(scan(docs), "pii")
    terms = disclosing(docs, scanned).groupBy("term").agg(F.max("n").alias("n"), F.max("share").alias("share"))
    located = _located_terms(docs, terms)
    base = F.transform("spans", lambda x: F.struct(x["start"], x["kind"], x["end"], F.lit(None).cast("double").alias("share")))
    if located is None:
        return scanned.select("doc_id", "hash", base.alias("spans"))
    added = located.select("d", "h", "share", F.explode("places").alias("x")).select("d", "h", "x.start", "x.end", "share")
    added = added.groupBy("d", "h").agg(F.collect_list(F.struct(
        "start", F.lit(KINDS.index("term")).alias("kind"), "end", "share")).alias("added"))
    met = scanned.join(added, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("h")), "left")
    return met.select("doc_id", "hash", F.when(F.col("added").isNull(), base).otherwise(
        F.array_sort(F.concat(base, "added"))).alias("spans"))


def names(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"], x["end"])), ",")


@F.arrow_udf(T.StringType())
def _sanitised(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, found in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
        if text is None or not found:
            out.append(text)
            continue
        parts, at = [], 0
        for x in found:
            if x["start"] < at:
                if x["end"] <= at:
                    continue
                x["start"] = at
            parts.append(text[at:x["start"]])
            word = text[x["start"]:x["end"]]
            if x["kind"] < 4:
                parts.append(f"[{KINDS[x['kind']].upper()}]")
            elif x["share"] < SURE:
                parts.append("[NUMBER]" if word.isdigit() else "[CODE]" if _DIGIT.search(word) else "[WORD]")
            at = x["end"]
        out.append("".join([*parts, text[at:]]))
    return pa.array(out, pa.string())


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with base spans replaced by their kind, and disclosing terms
    generalised or removed; same columns. Null texts stay null."""
    found = find(docs).groupBy(F.col("doc_id").alias("d"), F.col("hash").alias("h")).agg(F.first("spans").alias("spans"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), text_hash(F.col("text")).alias("hash"))
    met = rows.join(found, F.col("id").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("h")), "left")
    made = met.select("row", _sanitised(F.col("row.text"), F.col("spans")).alias("made"))
    return made.select(*[F.col("made").alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
