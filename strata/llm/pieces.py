"""SentencePiece encoding that keeps offsets, and decoding.

A text is normalised by longest-prefix matches in the model's compiled character
map (a double-array trie over replacement strings); every normalised byte keeps
the source byte it stands for. The library segments the normalised text as it
stands (with its own normaliser off), and each piece is projected through the
alignment to a span of bytes of the original text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
_ROWS = 256  # of a batch encoded at a time


class CharacterMap:
    """The compiled map: a 32-bit length, a double-array trie of that many
    bytes, then NUL-terminated replacements the trie's values point into."""

    def __init__(self, blob: bytes):
        length = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + length], "<u4").tolist() if blob else []
        self.texts = blob[4 + length:]
        self._found: dict[int, bytes] = {}

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest entry that ``data`` has at ``at``."""
        units, best = self.units, None
        if not units:
            return None
        pos = _offset(units[0])
        for i in range(at, len(data)):
            pos ^= data[i]
            if pos >= len(units) or units[pos] & 0x800000FF != data[i]:
                break
            unit = units[pos]
            pos ^= _offset(unit)
            if unit >> 8 & 1:
                best = i + 1 - at, units[pos] & 0x7FFFFFFF
        if best is None:
            return None
        if best[1] not in self._found:
            self._found[best[1]] = self.texts[best[1]:self.texts.index(b"\0", best[1])]
        return best[0], self._found[best[1]]


def _offset(unit: int) -> int:
    return unit >> 10 << ((unit & 512) >> 6)


class Pieces:
    """A model with everything a task needs to encode and decode."""

    def __init__(self, blob: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(blob)
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        if trainer.treat_whitespace_as_suffix or any(p.type == p.USER_DEFINED for p in proto.pieces):
            raise ValueError("models with user symbols or white space as a suffix aren't supported")
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.tidy, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=blob)
        # segments normalised text as it stands
        spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces = b"", False, False
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.bytes, self.special = [], {}
        for i, p in enumerate(proto.pieces):
            if p.type == p.BYTE:
                self.bytes.append(bytes([int(p.piece[3:-1], 16)]))
            elif p.type in (p.CONTROL, p.UNKNOWN):
                self.bytes.append(b"" if p.type == p.CONTROL else trainer.unk_surface.encode())
                self.special[i] = p.type
            else:
                self.bytes.append(p.piece.replace(SPACE, " ").encode())
        self.size = np.array([1 if p.type == p.BYTE else len(p.piece.encode()) for p in proto.pieces])
        self.unknown = self.whole.unk_id()

    def normalise(self, text: str) -> tuple[str, np.ndarray | None]:
        """The normalised text and, for each of its bytes and its end, the source
        byte where what it stands for begins. None: spaces alone were replaced."""
        if not text:
            return "", np.zeros(1, np.int64)
        if not self.map.units and not self.tidy and self.escape:
            return (SPACE if self.prefix else "") + text.replace(" ", SPACE), None
        data = text.encode()
        parts, at = [], 0
        while at < len(data):
            found = self.map.longest(data, at)
            if found is None:
                first = data[at]
                size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                found = size, data[at:at + size]
            parts.append((at, found[0], found[1]))
            at += found[0]
        if self.tidy:
            while parts and not parts[0][2].strip(b" "):
                parts.pop(0)
        space = SPACE.encode() if self.escape else b" "
        out, source = bytearray(), []
        if parts and self.prefix:
            out += space
            source += [parts[0][0]] * len(space)
        after_space = self.tidy
        for at, _, piece in parts:
            if after_space:
                piece = piece.lstrip(b" ")
            if piece:
                made = piece.replace(b" ", space)
                out += made
                source += [at] * len(made)
                after_space = self.tidy and piece.endswith(b" ")
        end = parts[-1][0] + parts[-1][1] if parts else len(data)
        while self.tidy and out.endswith(space):
            del out[-len(space):]
            end = source[-len(space)]
            del source[-len(space):]
        return out.decode(), np.array([*source, end], np.int64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the first and the end byte in ``text`` of each piece. A byte
        piece of a character spans what the byte stands for."""
        normal, source = self.normalise(text)
        ids = np.array(self.plain.encode(normal), np.int32)
        if self.unknown in ids:  # of models without byte pieces; such a piece is as long as its text
            found = self.plain.encode(normal, out_type="immutable_proto").pieces
            size = np.array([len(p.surface.replace(" ", SPACE).encode()) for p in found])
        else:
            size = self.size[ids]
        stop = np.cumsum(size)
        start = stop - size
        if source is None:
            # three bytes of each replaced space stand for one; the prefix for none
            data = np.frombuffer(normal.encode(), np.uint8)
            raw = np.frombuffer(text.encode(), np.uint8)
            if len(raw) + 3 * self.prefix != len(data):
                spaces = text.encode().replace(b" ", b"\xff")  # no byte of UTF-8
                marks = np.frombuffer(spaces, np.uint8) == 255
                size = np.where(marks, 3, 1)
                origin = np.repeat(np.arange(len(raw)), size)
            else:
                origin = np.arange(len(raw))
            source = np.concatenate([np.zeros(3 * self.prefix, np.int64), origin, [len(raw)]])
        return ids, source[start].astype(np.int32), source[stop].astype(np.int32)

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``, as the library gives it."""
        if not self.special.keys().isdisjoint(ids):
            return self.whole.decode(ids)
        table = self.bytes
        try:
            out = b"".join([table[i] for i in ids]).decode()
        except UnicodeDecodeError:  # byte pieces that aren't whole characters
            return self.whole.decode(ids)
        if self.tidy:
            return self.whole.decode(ids)
        return out[1:] if self.prefix and out.startswith(" ") else out


@lru_cache(maxsize=2)
def _loaded(blob: bytes) -> Pieces:
    return Pieces(blob)


def read_model(path: str) -> bytes:
    """A model file's bytes, read by the driver and broadcast (its size is fixed)."""
    with open(path, "rb") as file:
        return file.read()


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*parts, np.zeros(0, np.int32)]).astype(np.int32)))


def _coded(docs: DataFrame, model: bytes, made: tuple[str, ...]) -> DataFrame:
    """``docs`` with the columns in ``made``, which replace ones of their names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c.lower() not in made]
    rows = docs.select(*[F.col(f"`{c}`") for c in rest], F.col("text").alias("ids"))
    schema = rows.drop("ids").schema
    for name in made:
        schema = schema.add(name, T.StringType() if name == "decoded" else T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _loaded(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                found = [pieces.encode(t or "") for t in batch.column(batch.num_columns - 1).to_pylist()]
                columns = {"ids": 0, "starts": 1, "ends": 2}
                arrays = [pa.array([pieces.decode(x[0].tolist()) for x in found], pa.string()) if name == "decoded"
                          else _lists([x[columns[name]] for x in found]) for name in made]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], [*batch.schema.names[:-1], *made])

    return rows.mapInArrow(run, schema)


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """Adds ``ids``, ``starts`` and ``ends`` (arrays of int: pieces and the byte
    spans of the text's UTF-8 that they cover) to every row, without begin or
    end ids. Null and empty texts get empty arrays. Columns of these names give
    way, rows and repeats stay, and an empty table stays empty.
    """
    return _coded(docs, model, ("ids", "starts", "ends"))


def decode(coded: DataFrame, model: bytes) -> DataFrame:
    """Adds ``decoded``, the text of ``ids`` as the library gives it (null: null)."""
    shared = coded.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def run(ids: pa.Array) -> pa.Array:
        pieces = _loaded(shared.value)
        return pa.array([None if x is None else pieces.decode(x) for x in ids.to_pylist()], pa.string())

    return coded.withColumn("decoded", run(F.col("ids")))


def round_trip(docs: DataFrame, model: bytes) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` (the text that ``ids`` decode to), in one pass."""
    return _coded(docs.select("doc_id", "text"), model, ("ids", "decoded"))
