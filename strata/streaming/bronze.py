"""Incremental file ingestion into an all-string raw (bronze) layer.

One stateless Structured Streaming query per source:

    landing files --(file source: names, sizes, times)-->
      each micro-batch's files, read in their format, every column as text
      + envelope (_ingestion_ts, _ingestion_date, _source_file, batch_key)
    --(parquet, one directory per epoch, partitioned by batch_key)--> bronze
    --(one row per file)--> manifest

``trigger(availableNow=True)`` drains what has landed and stops; the
checkpoint makes every file count once, so a rerun adds nothing. A micro-batch
that is run again (an executor or the driver was lost) overwrites its own epoch
in bronze and in the manifest. A run looks at the files of its own
micro-batches only: neither older bronze nor older files are read to find out
what is new or which columns there are.

Nothing a file holds is lost:

* JSON is read as lines and parsed to a map of its top-level keys
  (nested values stay JSON text). Keys the schema store knows become columns,
  all others go to ``_rescued_data`` (a JSON object); after the micro-batch they are
  added to the store, and ``read_bronze`` fills the new columns from there. A
  line that isn't a JSON object is kept in ``_corrupt_record``.
* Names that differ only in case are one column, under the spelling seen first;
  the store keeps every spelling. Where one record has several with different
  values, the first spelling's is the column's and the others stay in ``_rescued_data``.
* With the option ``singleVariantColumn`` a JSON record is kept whole, as VARIANT,
  in the column that it names: keys keep their case, numbers their type, and new
  keys need no new columns (``functions.variants`` takes typed columns from it).
* CSV is mapped **by header name**: files are grouped by their header line and each group is read with its own
  columns plus ``_corrupt_record``, which keeps the text of lines with too many
  or too few values.
* Parquet and ORC are read in their own types; the schema store widens a column
  (also inside structs) when newer files carry a wider type or more fields.
* A source column named like an envelope column, or not named at all, is renamed ``source_<name>``.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import BATCH_KEY_PATTERN, batch_key_of
from strata.functions.variants import parsed
from strata.session import has_data, path_exists

ENVELOPE = ("_ingestion_ts", "_ingestion_date", "_source_file", "batch_key")
RESCUED, CORRUPT = "_rescued_data", "_corrupt_record"
#: Columns of ours that a source may also have, in any case; and our partition of micro-batches.
EPOCH = "_ingest_epoch"
_OWN = {c.lower() for c in (*ENVELOPE, RESCUED, CORRUPT, EPOCH)}
FORMATS = ("json", "parquet", "csv", "orc", "text")


@dataclass
class SourceSpec:
    """One landing zone: a directory of files of one format."""

    name: str
    fmt: str
    path: str
    options: Mapping[str, str] = field(default_factory=dict)
    batch_pattern: str = BATCH_KEY_PATTERN

    def __post_init__(self):
        if self.fmt not in FORMATS:
            raise ValueError(f"unsupported format {self.fmt!r}; expected one of {FORMATS}")


# ----------------------------------------------------------------------------
# Schema store
# ----------------------------------------------------------------------------

def _read_stored(spark: SparkSession, schema_path: str) -> T.StructType | None:
    if not has_data(spark, schema_path):
        return None
    return T.StructType.fromJson(json.loads(spark.read.text(schema_path).first()[0]))


def _store(spark: SparkSession, schema_path: str, schema: T.StructType) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(schema_path)


SPELLINGS = "spellings"


def _spellings(field: T.StructField) -> list[str]:
    """The names under which files have the column, the first seen first."""
    return list((field.metadata or {}).get(SPELLINGS, [field.name]))


def _spelled(field: T.StructField, more: Iterable[str]) -> T.StructField:
    known = _spellings(field)
    new = [n for n in more if n not in known]
    return T.StructField(field.name, field.dataType, True, {SPELLINGS: [*known, *new]}) if new else field


def _strings(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _with_names(stored: T.StructType, names: Iterable[str]) -> T.StructType:
    """Adds text columns that are missing, and spellings of ones that aren't."""
    fields = {f.name.lower(): f for f in stored}
    for n in sorted(set(names)):
        old = fields.get(n.lower())
        fields[n.lower()] = T.StructField(n, T.StringType()) if old is None else _spelled(old, [n])
    return T.StructType(list(fields.values()))


def _add_names(spark: SparkSession, schema_path: str, names: Iterable[str]) -> T.StructType:
    """The store with ``names`` added, in order of name."""
    stored = _read_stored(spark, schema_path)
    wanted = _with_names(stored or T.StructType([]), names)
    if stored is None or wanted.json() != stored.json():
        _store(spark, schema_path, wanted)
    return wanted


def _q(name: str) -> str:
    """A column name, quoted whole: dots in it are part of it."""
    return f"`{name.replace('`', '``')}`"


def _literal_path(path: str) -> str:
    """A path that a reader takes literally: with glob characters escaped."""
    for c in "\\{}[]*?":
        path = path.replace(c, "\\" + c)
    return path


def _norm(c: Column) -> Column:
    """One spelling per file: ``file:///x`` and ``file:/x`` are the same file."""
    return F.regexp_replace(c, r"^file:(//)?/", "file:/")


# ----------------------------------------------------------------------------
# Manifest
# ----------------------------------------------------------------------------

FILES = T.StructType([T.StructField("file", T.StringType()), T.StructField("bytes", T.LongType()),
                      T.StructField("modified", T.TimestampType()), T.StructField("epoch", T.LongType())])


def _manifest_path(bronze_path: str) -> str:
    return f"{bronze_path.rstrip('/')}_files"


def manifest(spark: SparkSession, bronze_path: str) -> DataFrame:
    """One row for each file ingested: (file, bytes, modified, epoch), as the
    micro-batches wrote them. Files of no bytes hold nothing and aren't listed."""
    path = _manifest_path(bronze_path)
    if not has_data(spark, path):
        return spark.createDataFrame([], FILES)
    rows = spark.read.schema(T.StructType([*FILES.fields[:3], T.StructField(EPOCH, T.LongType())])).parquet(path)
    return rows.withColumnRenamed(EPOCH, "epoch")


def _landed(reader, spec: SourceSpec) -> DataFrame:
    """(path, modificationTime, length) of the source's files; none is opened."""
    chosen = {k: v for k, v in spec.options.items() if k.lower() in ("pathglobfilter", "modifiedafter", "modifiedbefore")}
    whole = "path string, modificationTime timestamp, length long, content binary"
    return (reader.format("binaryFile").schema(whole).options(**chosen).option("recursiveFileLookup", "true").load(spec.path)
            .select("path", "modificationTime", "length"))


def new_files(spark: SparkSession, spec: SourceSpec, bronze_path: str | None) -> list[str]:
    """Landing files that the manifest doesn't have (a report; the ingest itself
    knows them from its checkpoint). Only the new names come to the driver."""
    if not path_exists(spark, spec.path):
        return []
    files = _landed(spark.read, spec).select(_norm(F.col("path")).alias("file"))
    if bronze_path:
        files = files.join(manifest(spark, bronze_path).select("file"), "file", "left_anti")
    return [r[0] for r in files.collect()]


# Native types a column may widen to when later files carry the wider one;
# Spark's Parquet reader reads the older, narrower files as the wider type.
_WIDER = {("integer", "long"), ("integer", "double"), ("float", "double"), ("short", "integer"),
          ("short", "long"), ("byte", "short"), ("byte", "integer"), ("byte", "long")}


def _widened(name: str, a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both; structs field by field. A change between
    unrelated types stops here with a clear message, not inside a task."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _merged(a, b, f"{name}.")
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_widened(name, a.elementType, b.elementType))
    x, y = a.typeName(), b.typeName()
    if (x, y) in _WIDER:
        return b
    if (y, x) in _WIDER:
        return a
    raise ValueError(f"column {name!r} changed type from {x} to {y}; "
                     "land it under a new column name or re-ingest the source")


def _merged(stored: T.StructType, found: T.StructType, prefix: str = "") -> T.StructType:
    seen = {f.name.lower(): f for f in found.fields}
    kept = []
    for f in stored.fields:
        new = seen.get(f.name.lower())
        kept.append(f if new is None else _spelled(T.StructField(
            f.name, _widened(prefix + f.name, f.dataType, new.dataType), True, f.metadata), [new.name] if not prefix else []))
    names = {f.name.lower() for f in stored.fields}
    return T.StructType([*kept, *[f for f in found.fields if f.name.lower() not in names]])


def evolve_schema(spark: SparkSession, spec: SourceSpec, schema_path: str, files: Iterable[str]) -> T.StructType:
    """Stored schema of a Parquet or ORC source, widened by ``files`` (paths; only
    their footers are read); new columns come last."""
    stored = _read_stored(spark, schema_path)
    merged = stored or T.StructType([])
    reader = spark.read.options(**dict(spec.options)).option("mergeSchema", "true").format(spec.fmt)
    paths = [_literal_path(f) for f in files]
    if paths:
        try:
            found = [reader.load(paths).schema]
        except (PySparkException, Py4JJavaError) as e:
            if "MERGE_SCHEMA" not in str(e) and "COLUMN_ALREADY_EXISTS" not in str(e):
                raise
            found = [reader.load(f).schema for f in paths]  # files of one drop differ in types: widen over each
        for schema in found:
            merged = _merged(merged, schema)
    if stored is None or merged.json() != stored.json():
        _store(spark, schema_path, merged)
    return merged


# ----------------------------------------------------------------------------
# Streams
# ----------------------------------------------------------------------------

def _as_text(df: DataFrame, c: str) -> Column:
    """A raw column as text: nested values (struct, array, map) as JSON,
    everything else by a plain cast."""
    t = df.schema[c].dataType
    col = F.col(_q(c))
    if isinstance(t, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(col)
    return col.cast("string")


def source_name(name: str) -> str:
    """The bronze column of a source column: its name, unless it is one of ours or empty."""
    return f"source_{name}" if not name or name.lower() in _OWN else name


def _envelope(columns: Mapping[str, Column], df: DataFrame, pattern: str) -> DataFrame:
    """``columns`` by bronze name, plus lineage; ``__file`` is the source file."""
    return df.select(
        *[c.alias(n) for n, c in columns.items()],
        F.current_timestamp().alias("_ingestion_ts"),
        F.current_date().alias("_ingestion_date"),
        F.col("__file").alias("_source_file"),
        batch_key_of(F.col("__file"), pattern).alias("batch_key"),
    )


_MAP = T.MapType(T.StringType(), T.StringType())


def _json_rows(lines: DataFrame, spec: SourceSpec) -> DataFrame:
    """(value, m, __file): each record's top-level keys as text. With
    ``multiLine`` a file is one record or an array of them."""
    options = {k: str(v) for k, v in spec.options.items() if k.lower() != "multiline"}
    if not _multi_line(spec):
        # blank lines aren't records, as in Spark's own reader
        rows = lines.filter(F.trim("value") != "")
        return rows.withColumn("m", F.from_json("value", _MAP, options))
    many = F.from_json("value", T.ArrayType(_MAP), options)
    whole = F.when(F.size(many) > 0, many).otherwise(F.array(F.from_json("value", _MAP, options)))
    return lines.withColumn("m", F.explode(whole))


def _whole_record(spec: SourceSpec) -> str | None:
    """The column that keeps whole records as VARIANT, if the source wants one."""
    return next((str(v) for k, v in spec.options.items() if k.lower() == "singlevariantcolumn"), None)


def _multi_line(spec: SourceSpec) -> bool:
    return any(k.lower() == "multiline" and str(v).lower() == "true" for k, v in spec.options.items())


def _lines(spark: SparkSession, spec: SourceSpec, files: list[str]) -> DataFrame:
    reader = spark.read.format("text").option("wholetext", str(spec.fmt == "json" and _multi_line(spec)).lower())
    return reader.load([_literal_path(f) for f in files]).select("value", F.col("_metadata.file_path").alias("__file"),
                                                                 F.col("_metadata.file_block_start").alias("__block"))


def _keys(maps: DataFrame, c: str) -> list[str]:
    return [r[0] for r in maps.select(F.explode(F.map_keys(c)).alias("k")).distinct().collect()]


def _first_spelling(m: Column, spellings: list[str]) -> Column:
    return m[spellings[0]] if len(spellings) == 1 else F.coalesce(*[m[n] for n in spellings])


def _json_batch(spark: SparkSession, spec: SourceSpec, files: list[str], schema_path: str) -> tuple[dict[str, Column], DataFrame]:
    whole = _whole_record(spec)
    if whole is not None:
        lines = _lines(spark, spec, files).filter(F.trim("value") != "")
        if _read_stored(spark, schema_path) is None:
            _store(spark, schema_path, T.StructType([T.StructField(whole, T.VariantType())]))
        record = parsed("value")
        return {source_name(whole): record, RESCUED: F.lit(None).cast("string"),
                CORRUPT: F.when(record.isNull(), F.col("value"))}, lines
    rows = _json_rows(_lines(spark, spec, files), spec)
    stored = _read_stored(spark, schema_path)
    if stored is None:  # the first files tell the first columns
        stored = _add_names(spark, schema_path, _keys(rows, "m"))
    m, known = F.col("m"), [n for f in stored for n in _spellings(f)]
    columns = {source_name(f.name): _first_spelling(m, _spellings(f)) for f in stored}

    def rescued(k: Column, v: Column) -> Column:
        unknown = ~F.array_contains(F.lit(known), k) if known else F.lit(True)
        for f in stored:  # a further spelling beside one that has a value
            names = _spellings(f)
            for n in range(1, len(names)):
                unknown = unknown | ((k == names[n]) & _first_spelling(m, names[:n]).isNotNull())
        return unknown

    rest = F.map_filter("m", rescued)
    columns[RESCUED] = F.when(F.size(rest) > 0, F.to_json(rest))
    columns[CORRUPT] = F.when(m.isNull(), F.col("value"))
    return columns, rows


def _csv_batch(spark: SparkSession, spec: SourceSpec, files: list[str], schema_path: str) -> tuple[dict[str, Column], DataFrame] | None:
    """Each file read with its own header; groups of one header unioned by column name."""
    first = (_lines(spark, spec, files).filter(F.col("__block") == 0)
             .withColumn("__mid", F.monotonically_increasing_id())
             .groupBy("__file").agg(F.min_by("value", "__mid").alias("__header")))
    # one row per file of this micro-batch (bounded by maxFilesPerTrigger)
    by_header: dict[str, list[str]] = {}
    for r in first.collect():
        by_header.setdefault(r["__header"], []).append(_literal_path(unquote(r["__file"])))
    opts = {"header": "true", **dict(spec.options)}
    read = []
    for group in by_header.values():
        header = spark.read.options(**opts).csv(group[0]).columns
        rows = (spark.read.options(**opts).option("enforceSchema", "true").option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT).schema(_strings([*header, CORRUPT])).csv(group))
        read.append((header, rows))
    if not read:
        return None
    stored = _add_names(spark, schema_path, [n for header, _ in read for n in header])
    column = {f.name.lower(): source_name(f.name) for f in stored}
    out = None
    for header, rows in read:
        # values of a broken line may stand under the wrong names: only its text is kept
        whole = F.col(CORRUPT).isNull()
        part = rows.select(*[F.when(whole, F.col(_q(c))).alias(column[c.lower()]) for c in header], CORRUPT,
                           F.col("_metadata.file_path").alias("__file"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return {c: F.col(_q(c)) for c in out.columns if c != "__file"}, out


def _native_batch(spark: SparkSession, spec: SourceSpec, files: list[str], schema_path: str) -> tuple[dict[str, Column], DataFrame]:
    if spec.fmt == "text":
        _add_names(spark, schema_path, ["value"])
        return {"value": F.col("value")}, _lines(spark, spec, files)
    schema = evolve_schema(spark, spec, schema_path, files)
    rows = (spark.read.schema(schema).options(**dict(spec.options)).format(spec.fmt).load([_literal_path(f) for f in files])
            .withColumn("__file", F.col("_metadata.file_path")))
    return {source_name(f.name): _as_text(rows, f.name) for f in schema}, rows


_READERS = {"json": _json_batch, "csv": _csv_batch}


def ingest(spark: SparkSession, spec: SourceSpec, bronze_path: str, checkpoint_path: str,
           schema_path: str, max_files_per_trigger: int = 1000, wait: bool = True):
    """Drain new files of ``spec`` into ``bronze_path``; returns the streaming
    query (finished when ``wait``, else to be awaited), or None when the landing
    zone doesn't exist yet."""
    if not path_exists(spark, spec.path):
        return None
    read = _READERS.get(spec.fmt, _native_batch)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        landed = batch.collect()  # names only, at most max_files_per_trigger
        if not landed:
            return
        found = read(spark, spec, [r["path"] for r in landed], schema_path)
        here = f"{bronze_path}/{EPOCH}={epoch}"
        if found is not None:
            columns, rows = found
            # foreachBatch is at-least-once: each epoch owns its directories and a
            # retry overwrites them, so a replayed micro-batch never duplicates rows
            _envelope(columns, rows, spec.batch_pattern).write.mode("overwrite").partitionBy("batch_key").parquet(here)
            if spec.fmt == "json" and _whole_record(spec) is None and has_data(spark, here):
                left = spark.read.schema(_strings([RESCUED])).parquet(here).filter(F.col(RESCUED).isNotNull())
                _add_names(spark, schema_path, _keys(left.select(F.from_json(RESCUED, _MAP).alias("m")), "m"))
        (batch.select(_norm(F.col("path")).alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
         .coalesce(1).write.mode("overwrite").parquet(f"{_manifest_path(bronze_path)}/{EPOCH}={epoch}"))

    files = _landed(spark.readStream.option("maxFilesPerTrigger", str(max_files_per_trigger)), spec)
    query = files.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query


def bronze_schema(stored: T.StructType) -> T.StructType:
    """The bronze columns of a source with the stored schema: all text, but for whole records."""
    own = [("_ingestion_ts", T.TimestampType()), ("_ingestion_date", T.DateType()), ("_source_file", T.StringType()),
           (RESCUED, T.StringType()), (CORRUPT, T.StringType()), ("batch_key", T.StringType())]
    data = [T.StructField(source_name(f.name), f.dataType if isinstance(f.dataType, T.VariantType) else T.StringType()) for f in stored]
    return T.StructType([*data, *[T.StructField(n, t) for n, t in own]])


def read_bronze(spark: SparkSession, bronze_path: str, schema_path: str) -> DataFrame:
    """Bronze rows of one source: all columns ever seen, as text, NULL where a
    file did not have the column. The columns come from the schema store (no
    footer is opened to find them); ones that a file had before the store knew
    them are filled from its rescued keys, and ``_rescued_data`` keeps the rest.
    """
    stored = _read_stored(spark, schema_path) or T.StructType([])
    schema = bronze_schema(stored)
    if not has_data(spark, bronze_path):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(bronze_path)
    df = df.select(*map(_q, schema.names))  # without our partition of micro-batches
    if not stored.fields or any(isinstance(f.dataType, T.VariantType) for f in stored):
        return df
    late = F.from_json(RESCUED, _MAP)
    value = {f.name: F.coalesce(F.col(_q(source_name(f.name))), _first_spelling(late, _spellings(f))) for f in stored}
    columns = {source_name(f.name): F.when(F.col(RESCUED).isNull(), F.col(_q(source_name(f.name)))).otherwise(value[f.name]) for f in stored}
    # a key whose value has become its column's is no longer rescued
    taken = F.create_map(*[c for f in stored for n in _spellings(f) for c in (F.lit(n), value[f.name])])
    known = F.lit([n for f in stored for n in _spellings(f)])
    rest = F.map_filter(late, lambda k, v: ~(F.array_contains(known, k) & (v.isNull() | v.eqNullSafe(taken[k]))))
    columns[RESCUED] = F.when(F.col(RESCUED).isNotNull() & (F.size(rest) > 0), F.to_json(rest))
    return df.select(*[columns.get(n, F.col(_q(n))).alias(n) for n in schema.names])


def discover_batches(*bronzes: DataFrame, required: bool = False) -> DataFrame:
    """Distinct batch keys over every source (a month with only product files
    still counts), in order. Lazy; the caller collects the short list.
    ``required``: an error when there is none."""
    keys = [b.select("batch_key") for b in bronzes]
    u = keys[0]
    for k in keys[1:]:
        u = u.unionByName(k)
    found = u.filter(F.col("batch_key").isNotNull() & (F.col("batch_key") != ""))
    if required and found.isEmpty():
        raise ValueError("no batch found in any source")
    return found.distinct().orderBy("batch_key")
