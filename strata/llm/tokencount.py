"""Token counts that follow edits.

A document keeps its pre-tokens (where each begins) and a segment tree whose
leaves are their token counts and whose inner nodes are sums. An edit touches the
pre-tokens it overlaps plus two before it (a pre-token's end can depend on the
characters of the two after it); from there the new text is split again until a
boundary coincides with an old one beyond the edit. Only what was split again is
encoded again; the first touched leaf takes the new count, the others drop to
zero, and the sums on the way to the root are updated. The root is the count.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.pii import KINDS, base_spans

_CACHE = 250_000
_BACK = 2
_ROWS = 256
#: White space as the tokenizer's library has it (Unicode's property).
_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

Edit = tuple[int, int, str]  # start, end (code points of the old text), new text


class Tokenizer:
    """A byte-pair encoding with its pre-token pattern and a bounded cache of counts."""

    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        merges = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        inside = pattern.replace(r"[^\s", f"[^{_SPACE}")
        self.pattern = regex.compile(inside.replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]"))
        self.counts: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self.counts.get(piece)
        if n is None:
            n = len(self.encoding.encode_ordinary(piece))
            if len(self.counts) < _CACHE:  # common pieces come early
                self.counts[piece] = n
        return n


@lru_cache(maxsize=2)
def _loaded(ranks: bytes, pattern: str) -> Tokenizer:
    return Tokenizer(ranks, pattern)


class Tree:
    """Sums over leaves: node 1 is the root, node k has the children 2k and 2k+1."""

    def __init__(self, leaves: np.ndarray):
        size = 1
        while size < len(leaves):
            size *= 2
        self.size = size
        self.node = np.zeros(2 * size, np.int64)
        self.node[size:size + len(leaves)] = leaves
        at = size
        while at > 1:
            self.node[at // 2:at] = self.node[at:2 * at:2] + self.node[at + 1:2 * at:2]
            at //= 2

    @property
    def total(self) -> int:
        return int(self.node[1])

    def put(self, first: int, stop: int, count: int) -> None:
        """Leaf ``first`` becomes ``count``, those up to ``stop`` zero; sums on the way up follow."""
        low, high = self.size + first, self.size + max(stop, first + 1)
        self.node[low:high] = 0
        self.node[low] = count
        while low > 1:
            low, high = low // 2, (high + 1) // 2
            self.node[low:high] = self.node[2 * low:2 * high:2] + self.node[2 * low + 1:2 * high:2]


class Counted:
    """A text with its pre-tokens and tree."""

    def __init__(self, text: str, tokenizer: Tokenizer):
        self.text, self.tokenizer = text, tokenizer
        pieces = tokenizer.pattern.findall(text)
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.stops = np.cumsum(length)
        self.starts = self.stops - length
        known = tokenizer.counts
        counts = [known.get(p) for p in pieces]
        if None in counts:
            counts = [tokenizer.count(p) if n is None else n for p, n in zip(pieces, counts, strict=True)]
        self.tree = Tree(np.array(counts, np.int64))

    def apply(self, edits: list[Edit]) -> tuple[str, int]:
        """The text after ``edits`` (in order, not overlapping), whose count the
        tree then has, and how many code points were encoded again."""
        parts, at = [], 0
        for start, end, new in edits:
            parts += [self.text[at:start], new]
            at = end
        text = "".join([*parts, self.text[at:]])
        starts, match, count = self.starts.tolist(), self.tokenizer.pattern.match, self.tokenizer.count
        boundary = {x: k for k, x in enumerate(starts)} if len(edits) > 8 else None
        done = again = shift = k = 0
        while k < len(edits):
            first = max(done, bisect_right(starts, edits[k][0] - 1) - 1 - _BACK, 0)
            p = (starts[first] if first < len(starts) else len(self.text)) + shift
            total, stop = 0, len(starts)
            while p < len(text):
                m = match(text, p)
                p = m.end()
                total += count(m.group())
                again += p - m.start()
                while k < len(edits) and p >= edits[k][0] + shift + len(edits[k][2]):
                    shift += len(edits[k][2]) - (edits[k][1] - edits[k][0])
                    k += 1
                old = p - shift
                if k < len(edits) and old > edits[k][0]:
                    continue
                here = boundary.get(old, -1) if boundary else bisect_right(starts, old) - 1
                if here < 0 or here >= len(starts) or starts[here] != old:
                    continue
                if k and old < edits[k - 1][1] or here < first:
                    continue
                if k < len(edits) and here > bisect_right(starts, edits[k][0] - 1) - 1 - _BACK:
                    continue  # the next edit's context has begun
                if here > first or total == 0:
                    stop = here
                    break
            else:
                k = len(edits)
            if not starts:
                self.tree.put(0, 1, total)
            elif first < len(starts):
                self.tree.put(first, stop, total)
            else:  # after the last pre-token; none is left to take the count
                raise AssertionError("an edit begins at a pre-token")
            done = stop
        return text, again


def cleaning_edits(text: str) -> list[Edit]:
    """What cleaning does to a text, as edits: base personal data become their
    kind, and a line that equals an earlier one of its text goes (with its
    newline), unless data lie in it."""
    spans, free, edits = base_spans(text), 0, []
    for start, kind, end in spans:
        if start >= free:
            edits.append((start, end, f"[{KINDS[kind].upper()}]"))
            free = end
    at, seen, gone = 0, set(), []
    for line in text.split("\n"):
        if line.strip() and line in seen:
            gone.append((max(0, at - 1), at + len(line), ""))
        seen.add(line)
        at += len(line) + 1
    gone = [g for g in gone if not any(s < g[1] and g[0] < e for s, e, _ in edits)] if edits else gone
    return sorted(edits + gone)


def read_ranks(path: str) -> bytes:
    """A vocabulary file's bytes, read by the driver and broadcast (its size is fixed)."""
    with open(path, "rb") as file:
        return file.read()


_COUNTS = "n_tokens_before long, n_edits long, n_reencoded long, n_tokens long"


def count_edited(docs: DataFrame, ranks: bytes, pattern: str, edits=cleaning_edits) -> DataFrame:
    """``docs`` with the texts after ``edits`` (a function of a text) and
    ``n_tokens_before``, ``n_edits``, ``n_reencoded`` (code points that were
    encoded again) and ``n_tokens`` (after).

    Null and empty texts stay as they are and count no tokens. Columns named
    like the new ones give way; rows and repeats stay, an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))
    taken = {"n_tokens_before", "n_edits", "n_reencoded", "n_tokens"}
    columns = [c for c in docs.columns if c.lower() not in taken]
    rows = docs.select(*[F.col(f"`{c}`") for c in columns])
    place = columns.index("text")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + [_COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _loaded(*shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch, out, numbers = whole.slice(at, _ROWS), [], []
                for text in batch.column(place).to_pylist():
                    if not text:
                        out.append(text)
                        numbers.append((0, 0, 0, 0))
                        continue
                    own = Counted(text, tokenizer)
                    before, made = own.tree.total, edits(text)
                    new, again = own.apply(made) if made else (text, 0)
                    out.append(new)
                    numbers.append((before, len(made), again, own.tree.total))
                arrays = list(batch.columns)
                arrays[place] = pa.array(out, batch.column(place).type)
                arrays += [pa.array([x[k] for x in numbers], pa.int64()) for k in range(4)]
                yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "n_tokens_before", "n_edits", "n_reencoded", "n_tokens"])

    return rows.mapInArrow(run, schema)
