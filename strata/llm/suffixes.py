"""Repeated byte strings, from the collection Burrows-Wheeler transform of the
places where documents may share them.

Every string of ``least`` bytes has an anchor, the least hash among its k-grams;
equal strings have equal anchors. Neighbouring strings with one anchor form a
piece. Anchors of one document only cannot repeat; the others send their pieces,
each distinct one of a task once, to shards by anchor. A shard is a collection of short
strings whose transform and common prefixes are built column by column: round
``j`` inserts, for every string at once, the suffix of ``j`` symbols at the place
that the counts of its first symbol give, and its common prefixes with both
neighbours from the least prefixes in between. A symbol is several bytes, as many
as divide ``least``. Runs of suffixes with a common prefix of ``least`` bytes are
one string; all but those of the smallest document that holds it go. A frequent
piece takes part in its shard once; its rows stay where they are and get its verdict.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise

LEAST = 50
#: Bytes of an anchor, and of the longer one that splits the pieces of a frequent anchor.
GRAM, LONG_GRAM = 24, 40
#: Text behind one bucket of anchors and behind one shard of pieces, text that a
#: task looks at at once, and distinct pieces that it holds before it sends them.
BUCKET_BYTES, SHARD_BYTES, CHUNK, HELD = 32_000_000, 600_000, 2_000_000, 200_000
#: An anchor that so many texts of one chunk have is frequent; the most frequent
#: ones (so many at most, whatever the input) are known everywhere.
FREQUENT, MOST_FREQUENT = 64, 1 << 17
#: Positions hashed at a time, so that their hashes stay in the processor's cache.
BLOCK = 1 << 15
#: Anchors have 48 bits, in the upper ones of 64.
_UPPER = np.uint64(0xFFFF_FFFF_FFFF_0000)
_TABLE = np.random.default_rng(50).integers(0, 2**64, 256, np.uint64)


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    by %= 64
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by)) if by else x


def gram_hashes(text: np.ndarray, size: int) -> np.ndarray:
    """64-bit cyclic polynomial hashes of all byte grams of ``size``, by doubling."""
    power, length, have, at = _TABLE[text], 1, None, 0
    while True:
        if size & length:  # the binary digits of the size, least first
            if have is None:
                have, at = power, length
            else:
                n = len(text) - at - length + 1
                have, at = _rotated(have[:n], length) ^ power[at:at + n], at + length
        if at == size:
            return have
        n = len(power) - length
        power, length = _rotated(power[:n], length) ^ power[length:], 2 * length


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        values, span = np.minimum(values[:-span], values[span:]), 2 * span
    return np.minimum(values[:len(values) - (width - span)], values[width - span:]) if span < width else values


def _anchor_of_each(text: np.ndarray, gram: int, least: int) -> np.ndarray:
    """The anchor of the string of ``least`` bytes at each position."""
    out = np.empty(len(text) - least + 1, np.uint64)
    for at in range(0, len(out), BLOCK):
        hashes = gram_hashes(text[at:at + BLOCK + least - 1], gram)
        out[at:at + BLOCK] = window_minima(hashes, least - gram + 1)
    return out & _UPPER


def anchors(text: bytes, lengths: np.ndarray, least: int, frequent: np.ndarray, split: bool = True) -> tuple[np.ndarray, ...]:
    """(start, strings, key, is_frequent) of the pieces of concatenated texts:
    ``strings`` neighbouring strings of ``least`` bytes from ``start`` on, of one
    text and one anchor, at most as many as one anchor can have without repeating.
    ``key`` is the anchor, or with ``split`` the longer one where that is frequent."""
    none = np.zeros(0, np.int64)
    if len(text) < least:
        return none, none, none.astype(np.uint64), none.astype(bool)
    a = np.frombuffer(text, np.uint8)
    ends = np.cumsum(lengths)
    whole = np.zeros(len(a) + 1, np.int32)
    long = lengths >= least
    np.add.at(whole, (ends - lengths)[long], 1)
    np.add.at(whole, ends[long] - least + 1, -1)
    inside = np.cumsum(whole[:len(a) - least + 1]) > 0
    # fewer than GRAM bytes in all strings: the whole string is its anchor
    small, large = min(GRAM, least), min(LONG_GRAM, least)
    key = _anchor_of_each(a, small, least)
    new = _changes(key, inside)
    first, end = _runs(new, inside)
    own, hot = key[first], np.zeros(len(first), bool)
    if len(frequent):
        hot = frequent[np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)] == own
        if split and hot.any():
            step = np.zeros(len(inside) + 1, np.int8)
            step[first[hot]] += 1
            step[end[hot]] -= 1
            often = np.cumsum(step[:-1], dtype=np.int8) > 0
            finer = _anchor_of_each(a, large, least)
            first, end = _runs(np.where(often, _changes(finer, often), new), inside)
            hot = often[first]
            own = np.where(hot, finer[first], key[first])
    width = least - small + 1
    if len(first) and (end - first).max() > width:
        parts = -(-(end - first) // width)
        which = np.repeat(np.arange(len(first)), parts)
        first = first[which] + width * (np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts))
        end, own, hot = np.minimum(first + width, end[which]), own[which], hot[which]
    return first, end - first, own, hot


def _changes(key: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Whether a run of one key begins at a place ``inside``."""
    new = inside.copy()
    new[1:] &= (key[1:] != key[:-1]) | ~inside[:-1]
    return new


def _runs(new: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places of runs and the places after their last."""
    last = inside.copy()
    last[:-1] &= new[1:] | ~inside[1:]
    return np.flatnonzero(new), np.flatnonzero(last) + 1


def _chunks(batches: Iterator[pa.RecordBatch], extra: int, least: int) -> Iterator[tuple[list, bytes, np.ndarray, np.ndarray]]:
    """Texts in chunks of bounded size: (their rows' first ``extra`` columns, the
    texts in a row, their lengths, where each begins in its row's text). Longer
    texts come in parts that share ``least`` - 1 bytes, so each string is in one."""
    rows, texts, begins, held = [], [], [], 0
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[:extra]]
        for k, text in enumerate(batch.columns[extra]):
            text, row = text.as_py(), tuple(c[k] for c in columns)
            for begin in range(0, max(1, len(text) - least + 1), CHUNK):
                rows.append(row)
                texts.append(text[begin:begin + CHUNK + least - 1])
                begins.append(begin)
                held += len(texts[-1])
                if held >= CHUNK:
                    yield rows, b"".join(texts), np.fromiter(map(len, texts), np.int64, len(texts)), np.array(begins, np.int64)
                    rows, texts, begins, held = [], [], [], 0
    if rows:
        yield rows, b"".join(texts), np.fromiter(map(len, texts), np.int64, len(texts)), np.array(begins, np.int64)


def _row_keys(start: np.ndarray, key: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (key, row) of pieces, by key."""
    row = np.searchsorted(np.cumsum(lengths), start, "right")
    if len(lengths) <= 1 << 16:  # an anchor leaves 16 bits for the row
        both = np.sort(key | row.astype(np.uint64))
        both = both[np.append(True, both[1:] != both[:-1])[:len(both)]]
        return both & _UPPER, (both & ~_UPPER).astype(np.int64)
    order = np.lexsort((row, key))
    key, row = key[order], row[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    return key[new], row[new]


def _frequent(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, text, lengths, _ in _chunks(batches, 0, least):
            start, _, key, _ = anchors(text, lengths, least, np.zeros(0, np.uint64))
            key = _row_keys(start, key, lengths)[0]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
            n = np.diff(np.append(first, len(key)))
            often = n >= FREQUENT
            yield pa.RecordBatch.from_arrays([pa.array(key[first[often]].view(np.int64)), pa.array(n[often])], ["key", "n"])

    return run


def _listed(least: int, buckets: int, frequent: np.ndarray):
    """Per bucket, the rows' distinct anchors; frequent ones are known to repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text, lengths, _ in _chunks(batches, 2, least):
            start, _, key, hot = anchors(text, lengths, least, frequent, split=False)
            key, row = _row_keys(start[~hot], key[~hot], lengths)
            bucket = (key >> np.uint64(24)) % np.uint64(buckets)
            order = np.lexsort((row, bucket))
            key, row, bucket = key[order], row[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            ids = np.array(rows, np.int64).reshape(-1, 2)
            out = []
            for k, r, b in zip(np.split(key, cuts), np.split(row, cuts), np.split(bucket, cuts), strict=True):
                if len(k):
                    used, many = np.unique(r, return_counts=True)
                    out.append((int(b[0]), ids[used].tobytes(), many.astype(np.uint32).tobytes(),
                                k.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()),
                                                  *[pa.array([x[c] for x in out], pa.binary()) for c in (1, 2, 3)]], LISTED_COLUMNS)

    return run


LISTED_COLUMNS = ["bucket", "ids", "counts", "keys"]
LISTED = "bucket long, ids binary, counts binary, keys binary"


def _widened(keys: bytes) -> np.ndarray:
    """Anchors from their upper six bytes."""
    out = np.zeros((len(keys) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(keys, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


#: Parts of rows (``doc``, ``sign``), by bucket of rows: how many each has, and all in a row.
PACKETS = "bucket long, ids binary, counts binary, parts binary"


def _packets(doc: np.ndarray, sign: np.ndarray, counts: np.ndarray, parts: np.ndarray, buckets: int) -> list[pa.Array]:
    """The columns of ``PACKETS``; ``parts`` has a line for each part, the rows' one behind the other."""
    bucket = ((sign.view(np.uint64) * _ODD >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    parts = parts.view(np.uint8).reshape(len(parts), parts.itemsize * parts.shape[1])[np.argsort(np.repeat(bucket, counts), kind="stable")]
    bucket, ids, counts = bucket[order], np.column_stack([doc[order], sign[order]]), counts[order].astype(np.uint32)
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[:len(bucket)])
    cuts, upto = np.append(first, len(bucket)).tolist(), np.append(0, np.cumsum(counts, dtype=np.int64)).tolist()
    out = [(ids[b:e].tobytes(), counts[b:e].tobytes(), parts[upto[b]:upto[e]].tobytes()) for b, e in zip(cuts, cuts[1:])]
    return [pa.array(bucket[first], pa.int64()), *[pa.array([x[c] for x in out], pa.binary()) for c in range(3)]]


ROW_PARTS = "doc long, sign long, parts binary"


def _gathered(size: int):
    """A bucket's rows, each with its parts of ``size`` bytes of all packets."""
    def run(packets: pa.Table) -> pa.Table:
        ids, counts, parts = (b"".join(packets.column(c).to_pylist()) for c in ("ids", "counts", "parts"))
        ids, counts = np.frombuffer(ids, np.int64).reshape(-1, 2), np.frombuffer(counts, np.uint32)
        order = np.lexsort((ids[:, 1], ids[:, 0]))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        ids, many = ids[order], counts[order]
        parts = np.frombuffer(parts, np.uint8).reshape(-1, size)[np.argsort(np.repeat(rank, counts), kind="stable")]
        first = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]).any(axis=1))[:len(ids)])
        offsets = size * np.append(0, np.cumsum(many, dtype=np.int64))[np.append(first, len(ids))]
        made = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(parts)]).cast(pa.binary())
        return pa.table({"doc": pa.array(ids[first, 0], pa.int64()), "sign": pa.array(ids[first, 1], pa.int64()), "parts": made})

    return run


def _shared(buckets: int):
    """A bucket's anchors that rows of several documents have, as packets by row."""
    def run(listed: pa.Table) -> pa.Table:
        docs, keys = [], []
        for ids, counts, own in zip(*(listed.column(c).to_pylist() for c in LISTED_COLUMNS[1:]), strict=True):
            docs.append(np.repeat(np.frombuffer(ids, np.int64).reshape(-1, 2), np.frombuffer(counts, np.uint32), axis=0))
            keys.append(_widened(own))
        rows, key = np.concatenate(docs), np.concatenate(keys)
        order = np.argsort(key, kind="stable")
        rows, key = rows[order], key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(first, len(key)))
        several = np.minimum.reduceat(rows[:, 0], first) != np.maximum.reduceat(rows[:, 0], first)
        keep = np.repeat(several, size)
        rows, key = rows[keep], key[keep]
        order = np.lexsort((rows[:, 1], rows[:, 0]))
        rows, key = rows[order], key[order]
        start = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1))[:len(rows)])
        parts = np.ascontiguousarray(key.view(np.uint8).reshape(-1, 8)[:, 2:])
        return pa.table(_packets(rows[start, 0], rows[start, 1], np.diff(np.append(start, len(rows))), parts, buckets),
                        ["bucket", "ids", "counts", "parts"])

    return run


PIECES = "shard long, content binary, first long, packed binary"


def _pack(contents: list[bytes], many: np.ndarray, doc: np.ndarray, sign: np.ndarray, start: np.ndarray) -> bytes:
    """Contents, in how many rows each is and those rows, compressed."""
    sizes = np.fromiter(map(len, contents), np.uint32, len(contents))
    arrays = (sizes, many.astype(np.uint32), doc, sign, start)
    return zstandard.compress(b"".join([struct.pack("<2q", len(contents), len(doc)), *[a.tobytes() for a in arrays], *contents]), 3)


def _unpack(packed: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = zstandard.decompress(packed)
    number, rows = struct.unpack_from("<2q", data)
    at, arrays = 16, []
    for count, kind in ((number, np.uint32), (number, np.uint32), (rows, np.int64), (rows, np.int64), (rows, np.int64)):
        arrays.append(np.frombuffer(data, kind, count, at))
        at += arrays[-1].nbytes
    ends = (np.cumsum(arrays[0], dtype=np.int64) + at).tolist()
    return [data[b:e] for b, e in zip([at, *ends[:-1]], ends, strict=True)], *arrays[1:]


def _numbered(contents, known: dict[bytes, int]) -> np.ndarray:
    """The contents' numbers, new ones appended to ``known``."""
    return np.fromiter([known.setdefault(c, len(known)) for c in contents], np.int64)


def _cut(least: int, frequent: np.ndarray, shards: int):
    """Pieces whose anchor several documents have, by shard: each distinct one
    that a task holds once, with the (doc, sign, start) of all. A frequent one is a row
    by itself, with its smallest document: the rows stay, its shard gets only that."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        seen: set[tuple] = set()  # repeated rows are one
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            out = []
            if known:
                which, hot, shard, doc, sign, start = map(np.concatenate, zip(*held, strict=True))
                contents, of, often = list(known), np.empty(len(known), np.int64), np.empty(len(known), bool)
                of[which], often[which] = shard, hot
                order = np.lexsort((of, often))
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                place = rank[which]
                rows = np.argsort(place, kind="stable")
                doc, sign, start = doc[rows], sign[rows], start[rows]
                many = np.bincount(place, minlength=len(order))
                of, often = of[order], often[order]
                cuts = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | often[1:]))
                ends, upto = np.append(cuts[1:], len(of)).tolist(), np.append(0, np.cumsum(many)).tolist()
                for b, e, s, h in zip(cuts.tolist(), ends, of[cuts].tolist(), often[cuts].tolist(), strict=True):
                    rows = slice(upto[b], upto[e])
                    own = [contents[k] for k in order[b:e].tolist()]
                    out.append((s, own[0] if h else None, int(doc[rows].min()) if h else None,
                                _pack(own, many[b:e], doc[rows], sign[rows], start[rows])))
            known.clear()
            seen.clear()
            held.clear()
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], t) for c, t in enumerate(kinds)],
                                              ["shard", "content", "first", "packed"])

        number = 0
        for rows, text, lengths, begin in _chunks(batches, 3, least):
            start, many, key, hot = anchors(text, lengths, least, frequent)
            begins = np.cumsum(lengths) - lengths
            row = np.searchsorted(begins + lengths, start, "right")
            lists = [r[2] or b"" for r in rows]
            owner = np.repeat(np.arange(len(rows)), [len(x) // 6 for x in lists])
            listed = np.sort(_folded(_widened(b"".join(lists)), owner))
            fresh = np.ones(len(rows), bool)
            for k, part in enumerate(zip(rows, begin.tolist(), lengths.tolist(), strict=True)):
                part = (*part[0][:2], *part[1:])
                fresh[k] = part not in seen
                seen.add(part)
            own = _folded(key, row)
            met = listed[np.minimum(np.searchsorted(listed, own), len(listed) - 1)] == own if len(listed) else np.zeros(len(own), bool)
            wanted = np.flatnonzero((hot | met) & fresh[row])
            row, start = row[wanted], start[wanted]
            which = _numbered([text[s:e] for s, e in zip(start.tolist(), (start + many[wanted] + least - 1).tolist(), strict=True)], known)
            shard = ((key[wanted] >> np.uint64(16)) * _ODD >> np.uint64(20)) % np.uint64(shards)
            ids = np.array([r[:2] for r in rows], np.int64)[row]
            held.append((which, hot[wanted], shard.astype(np.int64), ids[:, 0], ids[:, 1], start - begins[row] + begin[row]))
            number += len(which)
            if max(len(known), len(seen), number // 10) > HELD:
                yield flush()
                number = 0
        yield flush()

    return run


_ODD = np.uint64(0x9E3779B97F4A7C15)


def _folded(key: np.ndarray, row: np.ndarray) -> np.ndarray:
    """(key, row) in 64 bits; a clash lets a piece of one document in, which does no harm."""
    return key ^ (row.astype(np.uint64) + np.uint64(1)) * _ODD


class Collection:
    """The transform of a collection of strings, with common prefixes (up to
    255 symbols): ``bwt`` holds each suffix's symbol before (0: none), ``lcp`` is the common prefix with the suffix above; the empty suffixes come first.
    No common prefix reaches over a string's end. Symbols are the bytes, or with
    ``lengths`` those of the array ``strings``, one string behind the other."""

    def __init__(self, strings: list[bytes] | np.ndarray, lengths: np.ndarray | None = None):
        if lengths is None:
            lengths = np.fromiter(map(len, strings), np.int64, len(strings))
            strings = np.frombuffer(b"".join(strings), np.uint8)
        number = len(lengths)
        self.lengths = lengths
        longest = int(lengths.max()) if number else 0
        # symbols are those that occur, in order, from 1 on; 0 is the start of a string
        occur, code = np.unique(strings, return_inverse=True)
        kind = np.uint8 if len(occur) < 256 else np.uint16 if len(occur) < 1 << 16 else np.uint32
        self.columns = np.zeros((longest, number), kind)  # aligned at the strings' ends
        begins = np.cumsum(lengths) - lengths
        self.columns[np.arange(len(strings)) - np.repeat(begins - (longest - lengths), lengths), np.repeat(np.arange(number), lengths)] = code + 1
        self.whole = 0  # strings inserted whole
        self.bwt = self._before(np.arange(number), 0)
        self.lcp = np.zeros(number, np.uint8)
        place, alive = np.arange(number), np.arange(number)
        for done in range(1, longest + 1):
            place, alive = self._insert(place, alive, done)

    def _order(self) -> np.ndarray:
        """The suffixes by the symbol that goes before them."""
        if self.bwt.itemsize <= 2:
            return np.argsort(self.bwt, kind="stable")  # by counting
        pairs = self.bwt.astype(np.uint64) << np.uint64(32) | np.arange(len(self.bwt), dtype=np.uint64)
        pairs.sort()
        return (pairs & np.uint64(0xFFFF_FFFF)).view(np.int64)

    def _before(self, strings: np.ndarray, length: int) -> np.ndarray:
        """The symbol before the suffix of that length, of each string."""
        row = len(self.columns) - 1 - length
        symbol = self.columns[row][strings] if row >= 0 else np.zeros(len(strings), self.columns.dtype)
        ended = self.lengths[strings] <= length
        symbol[ended] = 0
        self.whole += np.count_nonzero(ended)
        return symbol

    def _insert(self, place: np.ndarray, strings: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """One round: the suffixes of ``length`` of all strings that have one, by
        the places of their suffixes one shorter."""
        more = self.lengths[strings] >= length
        place, strings = place[more], strings[more]
        down = np.argsort(place)[::-1]
        place, strings = place[down], strings[down]
        size, number = len(self.bwt), len(self.lengths)
        order = self._order()[self.whole:]
        rank = np.empty(size, np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        at = rank[place]  # among all suffixes with a symbol in front, those known and those of this round
        symbol = self.bwt[place]
        # least prefixes of 1, 2, 4 ... neighbours: equal symbols may lie far apart
        least, span = [self.lcp], 1
        while 2 * span <= size:
            least.append(np.minimum(least[-1][:-span], least[-1][span:]))
            span *= 2

        def common(other: np.ndarray, inside: np.ndarray, is_above: bool) -> np.ndarray:
            """One more than the common prefix with the neighbour of the same symbol in front."""
            out = np.zeros(len(at), np.uint8)
            near = order[np.where(inside, other, at)]
            same = np.flatnonzero(inside & (self.bwt[near] == symbol))
            above, below = (near[same], place[same]) if is_above else (place[same], near[same])
            level = np.frexp((below - above).astype(np.float64))[1] - 1
            for k in np.flatnonzero(np.bincount(level)).tolist():
                of = np.flatnonzero(level == k)
                low = np.minimum(least[k][above[of] + 1], least[k][below[of] + 1 - (1 << k)])
                out[same[of]] = np.minimum(low, 254) + 1
            return out

        own, following = common(at - 1, at > 0, True), common(at + 1, at < len(order) - 1, False)
        spot = at + number
        old = np.ones(size + len(at), bool)
        old[spot] = False
        bwt, new = np.empty(len(old), self.bwt.dtype), np.zeros(len(old) + 1, np.uint8)
        bwt[old], new[:-1][old] = self.bwt, self.lcp
        bwt[spot] = self._before(strings, length)
        new[spot + 1] = following
        new[spot] = own  # a suffix of this round below another: its own says the same
        self.bwt, self.lcp = bwt, new[:-1]
        return spot, strings

    def places(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(suffix length, strings, places) walked from the empty suffixes on."""
        order = self._order()
        number = len(self.lengths)
        rank = np.empty(len(self.bwt), np.int64)
        rank[order[self.whole:]] = np.arange(len(order) - self.whole) + number
        place, strings = np.arange(number), np.arange(number)
        for length in range(1, len(self.columns) + 1):
            more = self.lengths[strings] >= length
            strings = strings[more]
            place = rank[place[more]]
            yield length, strings, place


#: Bytes of a symbol at most; the transform takes a round for each symbol of the longest string.
WIDE = 10


def smallest(strings: list[bytes], first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each place where ``least`` bytes start, the smallest ``first`` of the
    strings that hold the same bytes anywhere, for all strings in a row, and where
    each string's begin. Several bytes are one symbol, as many as divide ``least``; a
    string is taken from its first, second ... byte on, so that every place begins one."""
    width = max(w for w in range(1, WIDE + 1) if least % w == 0)
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    begins, many = np.cumsum(sizes) - sizes, np.maximum(sizes - least + 1, 0)
    flat = np.frombuffer(b"".join(strings), np.uint8)
    wide = np.zeros(max(0, len(flat) - width + 1), np.uint64)
    for k in range(width):
        if k == 8:  # the first eight bytes' numbers leave room for the others
            wide = np.unique(wide, return_inverse=True)[1].astype(np.uint64)
        wide = wide << np.uint64(8) | flat[k:k + len(wide)]
    owner = [np.flatnonzero(many > k) for k in range(width)]
    shift = np.repeat(np.arange(width), [len(x) for x in owner])
    owner = np.concatenate(owner)
    lengths = (sizes[owner] - shift) // width
    within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    collection = Collection(wide[np.repeat(begins[owner] + shift, lengths) + width * within], lengths)
    value = np.full(len(collection.bwt), np.iinfo(np.int64).max)
    walked = [(length, s, p) for length, s, p in collection.places() if length >= least // width]
    for _, s, p in walked:
        value[p] = first[owner[s]]
    apart = collection.lcp < least // width
    run = np.cumsum(apart) - 1
    least_of = np.minimum.reduceat(value, np.flatnonzero(apart)) if len(value) else value
    start = np.cumsum(many) - many
    out = np.empty(many.sum(), np.int64)
    for length, s, p in walked:  # the suffix of this length starts so many symbols after the string's first
        out[start[owner[s]] + shift[s] + width * (lengths[s] - length)] = least_of[run[p]]
    return out, start


#: Verdicts: packets of spans, or for a frequent piece the smallest documents of its strings.
VERDICTS = f"{PACKETS}, shard long, content binary, low binary"


#: Rows that are compared place by place at a time.
ROWS = 1 << 15


def _spans(low: np.ndarray, begin: np.ndarray, which: np.ndarray, doc: np.ndarray, sign: np.ndarray, start: np.ndarray, least: int,
           buckets: int) -> list[pa.Array]:
    """Packets of spans (start, end): the strings of the rows' texts that a smaller document
    has. Row ``k`` holds piece ``which[k]`` from ``start[k]`` on; the smallest
    documents of a piece's strings are in ``low``, from its ``begin`` on."""
    size = np.diff(np.append(begin, len(low)))
    whole = np.maximum.reduceat(low, begin)[which] < doc
    some = np.flatnonzero(~whole & (np.minimum.reduceat(low, begin)[which] < doc))
    whole = np.flatnonzero(whole)
    found = [(whole, start[whole], start[whole] + size[which[whole]] - 1 + least)]
    for k in range(0, len(some), ROWS):
        rows = some[k:k + ROWS]
        many = size[which[rows]]
        row = np.repeat(rows, many)
        at = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        gone = np.flatnonzero(low[begin[which[row]] + at] < doc[row])
        row, at = row[gone], at[gone]
        # strings that neither meet nor overlap begin another span
        first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (np.diff(at) > least)))
        last = np.append(first[1:], len(row)) - 1
        found.append((row[first], start[row[first]] + at[first], start[row[first]] + at[last] + least))
    row, start, end = map(np.concatenate, zip(*found, strict=True))
    doc, sign = doc[row], sign[row]
    order = np.lexsort((end, start, sign, doc))
    doc, sign, start, end = doc[order], sign[order], start[order], end[order]
    other = np.append(True, (doc[1:] != doc[:-1]) | (sign[1:] != sign[:-1]))[:len(doc)]
    new = np.flatnonzero(other | np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))[:len(doc)])
    doc, sign, start, end = doc[new], sign[new], start[new], end[new]
    first = np.flatnonzero(other[new])
    return _packets(doc[first], sign[first], np.diff(np.append(first, len(doc))), np.column_stack([start, end]).astype(np.int64), buckets)


def _judge(least: int, buckets: int):
    """A shard's verdicts. Of frequent pieces only the smallest document is here."""
    def run(shard: pa.Table) -> pa.Table:
        known: dict[bytes, int] = {}
        held = [(np.zeros(0, np.int64),) * 4]
        spread, firsts = [], []
        for content, first, packed in zip(*(shard.column(c).to_pylist() for c in ("content", "first", "packed")), strict=True):
            if packed is None:
                spread.append(known.setdefault(content, len(known)))
                firsts.append(first)
            else:
                contents, many, *rows = _unpack(packed)
                held.append((np.repeat(_numbered(contents, known), many), *rows))
        which, doc, sign, start = map(np.concatenate, zip(*held, strict=True))
        held.clear()
        strings, first = list(known), np.full(len(known), np.iinfo(np.int64).max)
        np.minimum.at(first, which, doc)
        np.minimum.at(first, np.array(spread, np.int64), np.array(firsts, np.int64))
        low, begin = smallest(strings, first, least)
        end = np.append(begin[1:], len(low))
        columns = _spans(low, begin, which, doc, sign, start, least, buckets)
        out = [*columns, *[pa.nulls(len(columns[0]), t) for t in (pa.int64(), pa.binary(), pa.binary())]]
        of = [*[pa.nulls(len(spread), c.type) for c in columns], pa.array(shard.column("shard").to_pylist()[:1] * len(spread), pa.int64()),
              pa.array([strings[k] for k in spread], pa.binary()), pa.array([low[begin[k]:end[k]].tobytes() for k in spread], pa.binary())]
        names = ["bucket", "ids", "counts", "parts", "shard", "content", "low"]
        return pa.concat_tables([pa.table(out, names), pa.table(of, names)])

    return run


def _applied(least: int, buckets: int):
    """The spans of frequent pieces' rows, by the verdict on the piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, many, doc, sign, start = map(list, zip(*map(_unpack, batch.column(0).to_pylist()), strict=True))
                lows = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
                begin = np.cumsum([0, *map(len, lows[:-1])])
                which = np.repeat(np.arange(len(lows)), np.concatenate(many))
                yield pa.RecordBatch.from_arrays(
                    _spans(np.concatenate(lows), begin, which, *map(np.concatenate, (doc, sign, start)), least, buckets),
                    ["bucket", "ids", "counts", "parts"])

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc, sign, text): the texts that can take part."""
    return docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("sign"), F.col("text").cast("binary").alias("text"))


def repeated_strings(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc, sign, gone): bytes of the text with hash ``sign`` of document ``doc``
    covered by a string that a smaller document has; ``gone`` lists packed
    (start, end) pairs of 64 bits, which may overlap."""
    texts = _keyed(docs).filter(F.length("text") >= least)
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    often = texts.select("text").mapInArrow(_frequent(least), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    # bounded by MOST_FREQUENT rows; decides only how pieces travel
    often = often.orderBy(F.desc("n"), "key").limit(MOST_FREQUENT).select("key").collect()
    frequent = np.sort(np.array([r[0] for r in often], np.int64).view(np.uint64))
    buckets = max(1, -(-size // BUCKET_BYTES))
    listed = texts.mapInArrow(_listed(least, buckets, frequent), LISTED)
    shared = listed.groupBy("bucket").applyInArrow(_shared(buckets), PACKETS)
    # the anchors' shuffle is over before the texts' begins
    lists = materialise(shared.groupBy("bucket").applyInArrow(_gathered(6), ROW_PARTS), "anchors")
    met = texts.join(lists, ["doc", "sign"], "left").select("doc", "sign", "parts", "text")
    number = max(1, -(-size // SHARD_BYTES))
    pieces = materialise(met.mapInArrow(_cut(least, frequent, number), PIECES), "pieces", over=[lists])
    # rows of a frequent piece stay spread; its shard gets its smallest document, they get the verdict
    hot = pieces.filter("content IS NOT NULL")
    known = hot.groupBy("shard", "content").agg(F.min("first").alias("first")).withColumn("packed", F.lit(None).cast("binary"))
    judged = pieces.filter("content IS NULL").unionByName(known).groupBy("shard").applyInArrow(_judge(least, buckets), VERDICTS)
    judged = materialise(judged, "verdicts")
    verdicts = judged.filter("content IS NOT NULL").select("shard", "content", "low")
    spread = hot.join(verdicts, ["shard", "content"]).select("packed", "low").mapInArrow(_applied(least, buckets), PACKETS)
    spans = judged.filter("content IS NULL").select(*spread.columns).unionByName(spread)
    gone = spans.groupBy("bucket").applyInArrow(_gathered(16), ROW_PARTS).withColumnRenamed("parts", "gone")
    return materialise(gone, "gone", over=[pieces, judged])


def _merged(parts: bytes, size: int) -> np.ndarray:
    """The union of packed spans, in order."""
    spans = np.frombuffer(parts, np.int64).reshape(-1, 2)
    spans = np.minimum(spans[np.argsort(spans[:, 0], kind="stable")], size)
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    first = np.flatnonzero(new)
    return np.column_stack([spans[first, 0], reach[np.append(first[1:] - 1, len(spans) - 1)]])


def _without(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, gone in batches:
        out = []
        for text, parts in zip(texts.to_pylist(), gone.to_pylist(), strict=True):
            text = text or b""
            spans = _merged(parts, len(text)).tolist() if parts else []
            kept, at = [], 0
            for start, end in spans:
                kept.append(text[at:start])
                at = end
            out.append({"kept": b"".join([*kept, text[at:]]), "spans": [{"start": s, "end": e} for s, e in spans]})
        yield pa.array(out, pa.struct([("kept", pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]))


def drop_repeated_strings(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` with ``kept`` (binary: the text's bytes without those that a string
    of ``least`` bytes covers which also starts in a document with a smaller id),
    ``n_bytes``, ``n_removed`` and ``removed`` (spans of bytes, merged).

    Overlapping strings count, and all are judged on the input. Bytes that remain
    may break characters, hence binary. A null text counts as empty. Rows without an
    id neither lose bytes nor make others lose any; rows that share an id don't
    touch each other, equal texts of theirs lose the same. Columns named like the
    new ones give way; an empty table stays empty.
    """
    gone = repeated_strings(docs, least)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("sign"))
    met = rows.join(gone, ["doc", "sign"], "left")
    made = met.select("row", F.arrow_udf(_without, "kept binary, spans array<struct<start:long,end:long>>")(
        F.col("row.text").cast("binary"), F.col("gone")).alias("made"))
    taken = {"kept", "n_bytes", "n_removed", "removed"}
    lost = F.aggregate("made.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return made.select(*[F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in taken], F.col("made.kept").alias("kept"),
                       F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long").alias("n_bytes"), lost.alias("n_removed"),
                       F.col("made.spans").alias("removed"))
