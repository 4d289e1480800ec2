"""Phrases whose words belong together, from a weighted de Bruijn graph.

At each position of a piece the gram of up to ``longest`` words that starts
there is counted once; a full one is an edge between the nodes that its first
and its last words make. What is shorter is the correction for a piece's end: the
count of a node is the sum of its outgoing edges plus the ends that stop at it,
and so on down to single words.

Grams travel sorted and compressed, by buckets of their hash: first whole
grams, so that the continuations of a frequent node spread over all buckets;
then their prefixes, of which a bucket holds one row for each bucket before.
Edges that are frequent enough make the graph; its unary paths (nodes with one
edge in and one out) are compacted by pointer doubling.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialise

LONGEST, LEAST, TOP = 3, 10, 2000
#: Bytes of text behind one bucket, and distinct grams held by a task before it sends them.
BUCKET_BYTES = 4_000_000
HELD = 400_000
#: Edges of one row of a compacted path; longer ones are cut.
PATH_EDGES = 1024
#: Parts of a language that are ranked each by itself before the language is.
PARTS = 256
_CUT = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")

PACKED = "lang string, bucket long, grams binary, counts binary"
MERGED = f"{PACKED}, phrase binary, n long"


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of every piece."""
    for piece in text.lower().translate(_CUT).split(b"\n"):
        if words := piece.split():
            yield words


def _grams(text: bytes, longest: int) -> list[bytes]:
    """The gram that starts at each word, up to its piece's end."""
    out: list[bytes] = []
    for words in pieces(text):
        out += map(b" ".join, zip(*(words[k:] for k in range(longest))))
        out += [b" ".join(words[k:]) for k in range(max(0, len(words) - longest + 1), len(words))]
    return out


def _pack(lang: str, counted: dict[bytes, int], buckets: int) -> pa.RecordBatch:
    """One row for each bucket; grams contain no line feed."""
    by: dict[int, list[bytes]] = {}
    digest = xxhash.xxh3_64_intdigest
    for gram in counted:
        bucket = digest(gram) % buckets
        if bucket in by:
            by[bucket].append(gram)
        else:
            by[bucket] = [gram]
    for grams in by.values():  # sorted, neighbours share their first words
        grams.sort()
    pack = zstandard.ZstdCompressor(level=1).compress
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(by), pa.string()), pa.array(list(by), pa.int64()),
         pa.array([pack(b"\n".join(g)) for g in by.values()], pa.binary()),
         pa.array([pack(np.fromiter(map(counted.__getitem__, g), np.int64, len(g)).tobytes()) for g in by.values()], pa.binary())],
        ["lang", "bucket", "grams", "counts"])


def _unpack(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[list[bytes], list[int]]]:
    open_ = zstandard.ZstdDecompressor().decompress
    for grams, counts in zip(batch.column("grams").to_pylist(), batch.column("counts").to_pylist(), strict=True):
        yield open_(grams).split(b"\n"), np.frombuffer(open_(counts), np.int64).tolist()


def _count(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush():
            for lang, counted in held.items():
                yield _pack(lang, counted, buckets)
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counted = held.setdefault(lang, Counter())
                counted.update(_grams(text.as_py(), longest))
                if sum(map(len, held.values())) > HELD:
                    yield from flush()
        yield from flush()

    return run


def _merge(words: int, least: int, buckets: int):
    """Sums a bucket's grams of up to ``words`` words: the frequent ones with
    exactly as many, and the prefixes of all, packed for the next level."""
    def run(key: tuple, packed: pa.Table) -> pa.Table:
        total: dict[bytes, int] = {}
        known = total.get
        for grams, counts in _unpack(packed):
            for gram, n in zip(grams, counts, strict=True):
                total[gram] = known(gram, 0) + n
        lang = key[0].as_py()
        kept = [(g, n) for g, n in total.items() if n >= least and g.count(b" ") == words - 1]
        sums: dict[bytes, int] = {}
        known = sums.get
        if words > 1:
            for gram, n in total.items():
                if gram.count(b" ") == words - 1:
                    gram = gram[:gram.rindex(b" ")]
                sums[gram] = known(gram, 0) + n
        else:  # the words that there are
            kept.append((None, sum(total.values())))
        sent = _pack(lang, sums, buckets)
        rows = pa.Table.from_batches([sent])
        rows = rows.append_column("phrase", pa.nulls(len(rows), pa.binary())).append_column("n", pa.nulls(len(rows), pa.int64()))
        found = pa.table({"lang": pa.array(list(repeat(lang, len(kept))), pa.string()), "bucket": pa.nulls(len(kept), pa.int64()),
                          "grams": pa.nulls(len(kept), pa.binary()), "counts": pa.nulls(len(kept), pa.binary()),
                          "phrase": pa.array([g for g, _ in kept], pa.binary()), "n": pa.array([n for _, n in kept], pa.int64())})
        return pa.concat_tables([rows, found])

    return run


def gram_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """(lang, words, phrase, n): phrases of 1 to ``longest`` words found at least
    ``least`` times in their language, and a row of null phrase with all words."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    packed, out = rows.mapInArrow(_count(longest, buckets), PACKED), None
    for words in range(longest, 0, -1):
        merged = materialise(packed.groupBy("lang", "bucket").applyInArrow(_merge(words, least, buckets), MERGED), f"grams-{words}")
        kept = merged.filter("bucket IS NULL").select(
            "lang", F.lit(words).alias("words"), F.col("phrase").cast("string").alias("phrase"), "n")
        out = kept if out is None else out.unionByName(kept)
        packed = merged.filter("bucket IS NOT NULL").select("lang", "bucket", "grams", "counts")
    return out


def _edges(grams: DataFrame) -> DataFrame:
    """(lang, edge, from, to, n) of the longest grams."""
    w = F.split("phrase", " ")
    return grams.select("lang", F.col("phrase").alias("edge"), F.array_join(F.slice(w, F.lit(1), F.size(w) - 1), " ").alias("from"),
                        F.array_join(F.slice(w, F.lit(2), F.size(w) - 1), " ").alias("to"), "n")


def compacted(grams: DataFrame) -> DataFrame:
    """(lang, path, nodes, weights): the graph of the longest grams with its unary
    paths compacted; a path with k edges has k weights and k + 1 nodes. Paths are
    cut every ``PATH_EDGES`` edges; edges of a unary cycle stay single."""
    edges = materialise(_edges(grams), "edges")
    ends = edges.select("lang", F.col("to").alias("node"), F.col("edge").alias("into"), F.lit(None).cast("string").alias("out")).unionByName(
        edges.select("lang", F.col("from").alias("node"), F.lit(None).cast("string").alias("into"), F.col("edge").alias("out")))
    unary = ends.groupBy("lang", "node").agg(
        F.count("into").alias("n_in"), F.count("out").alias("n_out"), F.max("into").alias("into"), F.max("out").alias("out"))
    unary = unary.filter("n_in = 1 AND n_out = 1 AND into != out").select("lang", F.col("out").alias("edge"), F.col("into").alias("before"))
    # each edge points back along its path; doubling until all point at a first edge
    linked = materialise(edges.select("lang", "edge").join(unary, ["lang", "edge"], "left").select(
        "lang", "edge", F.coalesce("before", "edge").alias("head"), F.when(F.col("before").isNull(), 0).otherwise(1).cast("long").alias("at"),
        F.col("before").isNull().alias("done")), "links")
    open_, before = linked.filter("NOT done").count(), -1
    while open_ not in (0, before):  # each round ends some, unless all that is left goes round
        ahead = linked.select("lang", F.col("edge").alias("head"), F.col("head").alias("head2"), F.col("at").alias("at2"), F.col("done").alias("done2"))
        # a pointer that met a first edge is final, the others take their target's
        stepped = linked.filter("NOT done").join(ahead, ["lang", "head"]).select(
            "lang", "edge", F.col("head2").alias("head"), (F.col("at") + F.col("at2")).alias("at"), F.col("done2").alias("done"))
        linked = materialise(linked.filter("done").unionByName(stepped), "links")
        open_, before = linked.filter("NOT done").count(), open_
    # what still has no first edge is a circle
    linked = linked.select("lang", "edge", F.when(F.col("done"), F.col("head")).otherwise(F.col("edge")).alias("head"),
                           F.when(F.col("done"), F.col("at")).otherwise(F.lit(0)).alias("at"))
    part = F.floor(F.col("at") / PATH_EDGES)
    paths = edges.join(linked, ["lang", "edge"]).groupBy("lang", F.col("head").alias("path"), part.alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("at", "from", "to", "n"))).alias("e"))
    return paths.select("lang", "path", "part", F.concat(F.array(F.col("e")[0]["from"]), F.col("e.to")).alias("nodes"), F.col("e.n").alias("weights"))


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, share: int = 50) -> DataFrame:
    """Each language's first ``top`` phrases of 2 to ``longest`` words by score:
    (lang, rank, phrase, a, l, r, n, score).

    A null text is an empty one, a null language ``und``; a language without
    phrases has no rows, nor has an empty table. Repeated rows count as often as they stand
    there. Ties are broken by ``a``, then the phrase's bytes. Columns of the
    input other than ``lang`` and ``text`` don't matter.
    """
    counted = materialise(gram_counts(docs, longest, least), "gram-counts")
    known = counted.filter("phrase IS NOT NULL")
    words = counted.filter("phrase IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    candidates = known.filter("words > 1")
    w = F.split("phrase", " ")
    cuts = candidates.select("lang", "words", "phrase", F.col("n").alias("a"), w.alias("w"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "words", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"))
    left = known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    big = "CAST({} AS DECIMAL(19, 0))"
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn(
        "score", F.expr(f"({big.format('a')} * {big.format('a')} * CAST(1000000 AS DECIMAL(7, 0))) div ({big.format('l')} * {big.format('r')})"))
    best = scored.groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "words", "phrase", "a", "cut.*")
    # what a longer candidate holds: the heaviest edge at each node, read off the
    # paths; words further inside lie in a node, whose own count is no smaller
    paths = materialise(compacted(known.filter(F.col("words") == longest).select("lang", "phrase", "n")), "paths")
    touched = paths.select("lang", F.explode(F.transform("nodes", lambda node, i: F.struct(
        node.alias("phrase"), F.array_max(F.slice("weights", F.greatest(i, F.lit(1)), F.least(i, F.lit(1)) + 1)).alias("longer")))).alias("t"))
    heaviest = touched.select("lang", "t.*").groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    for inner in range(longest - 1, 2, -1):  # and shorter candidates inside those nodes
        inside = candidates.filter(F.col("words") == inner).select("lang", F.col("phrase").alias("whole"), F.col("n").alias("longer"))
        e = _edges(inside.select("lang", F.col("whole").alias("phrase"), F.col("longer").alias("n")))
        heaviest = heaviest.unionByName(e.select("lang", F.explode(F.array("from", "to")).alias("phrase"), F.col("n").alias("longer")))
    heaviest = heaviest.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = best.join(heaviest, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    # the first of a language are among the first of its parts, so that no task sorts all of it
    best_first = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*best_first)
    first = kept.withColumn("rank", F.row_number().over(parts)).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best_first))).filter(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
