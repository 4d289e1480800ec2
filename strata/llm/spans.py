"""Repeated spans of sentences.

Every run of ``RUN`` consecutive sentences with at least ``LEAST_WORDS`` words (of
as many more as it takes, where sentences are short and runs may grow) is hashed (128 bits, white space collapsed); runs are joined over all documents; in
every occurrence but the first (by document id, then position) the sentences of
the run are removed. A passage that several documents share loses all the
sentences that lie wholly in it, everywhere but in its first place.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise

RUN = 2
LEAST_WORDS = 10
#: A sentence of more words is cut after the word of least hash of every ``WINDOW``
#: neighbouring ones, so that passages without full stops repeat in parts, wherever
#: they begin: cuts at least a window from a passage's ends are the same in all its
#: copies and at most a window apart, so one of over 50 words shares two parts with
#: ten words or more; up to two windows at either end may stay.
LONG = 12
WINDOW = 10
#: The document of rows without an id; it comes after all others.
NO_ID = 2**63 - 1

_END = re.compile(rb"[.!?](?=[\x20\x09-\x0d])|\n")
_WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def _cuts(words: list[bytes]) -> list[int]:
    """The first word of least hash of every window, in order."""
    hashed = list(map(zlib.crc32, words))
    cuts, best = [], -1
    for start in range(len(hashed) - WINDOW + 1):
        last = start + WINDOW - 1
        if best < start:  # the least has left the window
            window = hashed[start:last + 1]
            best = start + window.index(min(window))
            cuts.append(best)
        elif hashed[last] < hashed[best]:
            best = last
            cuts.append(best)
    return cuts


def sentences(text: bytes) -> list[tuple[int, int, list[bytes]]]:
    """(start, end, words) of the sentences that have a word, in order; between
    them they cover the text but for leading and trailing blanks."""
    out, start = [], 0
    for end in [*(m.end() for m in _END.finditer(text)), len(text)]:
        words = text[start:end].split()
        if len(words) > LONG:
            ends = [m.end() for m in _WORD.finditer(text, start, end)]
            at, first = start, 0
            for cut in _cuts(words):
                out.append((at, ends[cut], words[first:cut + 1]))
                at, first = ends[cut], cut + 1
            if first < len(words):
                out.append((at, end, words[first:]))
            start = end
        elif words:
            out.append((start, end, words))
            start = end
    return out


def _runs(found: list[tuple[int, int, list[bytes]]], run: int, least: int, grow: bool) -> dict[tuple[int, int], bytes]:
    """(first sentence, number of sentences) of the runs, and their hashes.

    Runs have ``run`` sentences and ``least`` words. With ``grow``, a run of fewer
    words grows forward from each sentence, and backward to each one, until it has
    as many; so every stretch with as many is covered by runs inside it."""
    size = np.concatenate([[0], np.cumsum([len(w) for _, _, w in found], dtype=np.int64)])
    at = np.arange(len(found))
    own = [xxhash.xxh3_128_digest(b" ".join(w)) for _, _, w in found]
    if not grow:
        whole = np.flatnonzero(size[run:] - size[:-run] >= least).tolist() if len(found) >= run else []
        return {(k, run): xxhash.xxh3_128_digest(b"".join(own[k:k + run])) for k in whole}
    end = np.maximum(at + run, np.searchsorted(size, size[:-1] + least))
    start = np.minimum(at + 1 - run, np.searchsorted(size, size[1:] - least, "right") - 1)
    spans = {(k, e - k) for k, e in zip(at.tolist(), end.tolist(), strict=True) if e <= len(found)}
    spans.update((s, k + 1 - s) for k, s in zip(at.tolist(), start.tolist(), strict=True) if s >= 0)
    return {(k, n): xxhash.xxh3_128_digest(b"".join(own[k:k + n])) for k, n in sorted(spans)}


#: Bytes of text behind one bucket of hashes, and hashes that a task holds before it sends them.
BUCKET_BYTES, HELD = 16_000_000, 300_000
#: Small inputs have so many buckets too, so that all cores have some.
LEAST_BUCKETS = 64
LISTED = "bucket long, ids binary, places binary, keys binary, doc long, sign long, gone binary"
GONE = "doc long, sign long, gone binary"


def _packed(places: list[tuple[int, int]]) -> bytes:
    return np.array(places, np.int32).tobytes()


def _listed(run: int, least: int, grow: bool, buckets: int):
    """Runs by bucket of their hash, each with the first of its places that the
    task holds: (document, text hash, number of runs) of the texts, then first
    sentence and size, and hash, of each run. A task's later places of a hash can't
    be the first anywhere, so they go; they travel on their own, by document, and
    a hash that a third of all texts have is one row a task."""
    def send(held: dict[bytes, tuple], more: list[tuple], gone: dict[tuple, list]) -> pa.RecordBatch:
        out = [(doc % buckets, None, None, None, doc, sign, _packed(places)) for (doc, sign), places in gone.items()]
        rows = [(*place, key) for key, place in held.items()] + more
        if rows:
            keys = np.frombuffer(b"".join(r[4] for r in rows), np.uint64).reshape(-1, 2)
            places = np.array([r[:4] for r in rows], np.int64)  # document, first sentence, size, text hash
            bucket = (keys[:, 0] >> np.uint64(16)) % np.uint64(buckets)
            order = np.lexsort((places[:, 1], places[:, 3], places[:, 0], bucket))
            keys, places, bucket = keys[order], places[order], bucket[order].astype(np.int64)
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            for own, part, b in zip(np.split(keys, cuts), np.split(places, cuts), bucket[np.append(0, cuts)].tolist(), strict=True):
                first = np.flatnonzero(np.append(True, (np.diff(part[:, [0, 3]], axis=0) != 0).any(axis=1)))
                ids = np.column_stack([part[first, 0], part[first, 3], np.diff(np.append(first, len(part)))])
                out.append((b, ids.tobytes(), part[:, 1:3].astype(np.int32).tobytes(), own.tobytes(), None, None, None))
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], t) for c, t in enumerate(kinds)],
                                          ["bucket", "ids", "places", "keys", "doc", "sign", "gone"])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple] = {}
        more: list[tuple] = []  # the same place in another text of the document
        gone: dict[tuple, list] = {}
        for batch in batches:
            for doc, sign, text in zip(*(c.to_pylist() for c in batch.columns[:2]), batch.column(2), strict=True):
                for (at, size), key in _runs(sentences(text.as_py()), run, least, grow).items():
                    old = held.get(key)
                    if old is None:
                        held[key] = (doc, at, size, sign)
                    elif (doc, at) > old[:2]:
                        gone.setdefault((doc, sign), []).append((at, size))
                    elif (doc, at) < old[:2]:
                        gone.setdefault((old[0], old[3]), []).append(old[1:3])
                        held[key] = (doc, at, size, sign)
                    elif sign != old[3]:
                        more.append((doc, at, size, sign, key))
                if len(held) > HELD:
                    yield send(held, more, gone)
                    held, more, gone = {}, [], {}
        yield send(held, more, gone)

    return go


def _decide(bucket: pa.Table) -> pa.Table:
    """All places of the bucket's hashes but the first of each, by text."""
    gone = bucket.filter(bucket.column("gone").is_valid()).select(["doc", "sign", "gone"])
    columns = [bucket.column(c).to_pylist() for c in ("ids", "places", "keys")]
    ids, places, keys = ([x for x in c if x is not None] for c in columns)
    if not ids:
        return gone
    ids = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 3) for x in ids])
    places = np.concatenate([np.frombuffer(x, np.int32).reshape(-1, 2) for x in places])
    keys = np.concatenate([np.frombuffer(x, np.uint64).reshape(-1, 2) for x in keys])
    owner = np.repeat(np.arange(len(ids)), ids[:, 2])
    doc, at = ids[owner, 0], places[:, 0]
    order = np.lexsort((at, doc, keys[:, 1], keys[:, 0]))
    new = np.append(True, (np.diff(keys[order].view(np.int64), axis=0) != 0).any(axis=1))
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = order[(doc[order] != doc[first]) | (at[order] != at[first])]
    later = later[np.argsort(owner[later], kind="stable")]
    start = np.flatnonzero(np.append(True, np.diff(owner[later]) != 0)) if len(later) else np.zeros(0, np.int64)
    own = owner[later][start]
    found = pa.table({"doc": pa.array(ids[own, 0], pa.int64()), "sign": pa.array(ids[own, 1], pa.int64()),
                      "gone": pa.array([p.tobytes() for p in np.split(places[later], start[1:])] if len(start) else [], pa.binary())})
    return pa.concat_tables([gone, found])


def _id():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))


def repeated_runs(docs: DataFrame, run: int = RUN, least: int = LEAST_WORDS, grow: bool = False) -> DataFrame:
    """(doc, sign, gone): the runs, of the text with hash ``sign`` of document
    ``doc``, that aren't the first of their kind, packed as (number of the run's
    first sentence, how many it has) of 32 bits; a text may have several rows."""
    texts = docs.filter("text IS NOT NULL").select(_id().alias("doc"), F.xxhash64("text").alias("sign"), F.col("text").cast("binary").alias("text"))
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    return texts.mapInArrow(_listed(run, least, grow, buckets), LISTED).groupBy("bucket").applyInArrow(_decide, GONE)


_MADE = "text binary, n_sentences int, n_removed int, spans array<struct<start:int,end:int>>"


def _without():
    def go(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, repeated in batches:
            out = []
            for text, runs in zip(texts.to_pylist(), repeated.to_pylist(), strict=True):
                found = sentences(text) if text else []
                gone: set[int] = set()
                for packed in runs or ():
                    for at, size in np.frombuffer(packed, np.int32).reshape(-1, 2).tolist():
                        gone.update(range(at, at + size))
                spans = [{"start": found[k][0], "end": found[k][1]} for k in sorted(gone)]
                kept, at = [], 0
                for s in spans:
                    kept.append(text[at:s["start"]])
                    at = s["end"]
                out.append({"text": b"".join([*kept, text[at:]]) if gone else text, "n_sentences": len(found),
                            "n_removed": len(gone), "spans": spans})
            yield pa.array(out, pa.struct([("text", pa.binary()), ("n_sentences", pa.int32()), ("n_removed", pa.int32()),
                                           ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]))

    return F.arrow_udf(go, _MADE)


def drop_repeated_spans(docs: DataFrame, run: int = RUN, least: int = LEAST_WORDS, grow: bool = False) -> DataFrame:
    """``docs`` without the sentences of repeated runs, plus ``n_sentences``,
    ``n_removed`` and ``removed`` (byte spans of the old text).

    Without ``grow``, runs are of ``run`` sentences and short ones have none; with
    it, runs of short sentences grow until they have ``least`` words.
    A null text stays null and an empty one empty. Rows of one id are one
    document; rows without an id together are one that comes last. Columns named
    like the new ones give way; an empty table stays empty.
    """
    gone = materialise(repeated_runs(docs, run, least, grow).groupBy("doc", "sign").agg(F.collect_list("gone").alias("runs")), "gone")
    rows = docs.select(F.struct("*").alias("row"), _id().alias("doc"), F.xxhash64("text").alias("sign"))
    met = rows.join(gone, ["doc", "sign"], "left")
    made = met.select("row", _without()(F.col("row.text").cast("binary"), F.col("runs")).alias("made"))
    taken = {"n_sentences", "n_removed", "removed"}
    return made.select(
        *[(F.col("made.text").cast("string").alias(c) if c == "text" else F.col(f"row.`{c}`"))
          for c in docs.columns if c.lower() not in taken],
        F.col("made.n_sentences").cast("long").alias("n_sentences"), F.col("made.n_removed").cast("long").alias("n_removed"),
        F.col("made.spans").alias("removed"))
