"""Readers of caption documents, CSV and JSON tables, and files below a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from captionloom import schemas
from captionloom.functions import text as tx
from captionloom.work import Work

# fixed values: suffixes that are never media
NOT_MEDIA = (".json3", ".json", ".txt", ".csv", ".part", ".ytdl")


def caption_documents(spark: SparkSession, path: str) -> DataFrame:
    """video_id (file name up to the first dot) and the content of every JSON3 file at path."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json3")
    name = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1)
    return files.select(F.split(name, "\\.")[0].alias("video_id"), F.col("value").alias("content"))


def caption_events(documents: DataFrame) -> DataFrame:
    """Timed events of documents(video_id, content). Events without text go; the others keep their index. A missing
    start or duration is zero; a document that is no JSON has no events."""
    parsed = documents.select("video_id", F.from_json("content", schemas.JSON3).alias("doc"))
    rows = parsed.select("video_id", F.posexplode("doc.events").alias("event_index", "e"))
    raw = F.array_join(F.transform("e.segs", lambda s: F.coalesce(s["utf8"], F.lit(""))), "")
    ms = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    rows = rows.select(
        "video_id",
        "event_index",
        (ms("e.tStartMs") / 1000).alias("start_sec"),
        ((ms("e.tStartMs") + ms("e.dDurationMs")) / 1000).alias("end_sec"),
        (ms("e.dDurationMs") / 1000).alias("duration_sec"),
        F.coalesce(raw, F.lit("")).alias("raw_text"),
    )
    rows = rows.withColumn("text", tx.clean(F.col("raw_text"))).where("text <> ''")
    return rows.withColumn("ends_terminal_punctuation", tx.is_terminal(F.col("text")))


def csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table with a header; quoted line feeds, doubled quotes and a byte order mark are read as meant."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")


def json_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def first_files(spark: SparkSession, path: str, pattern: str = "*", media_only: bool = False) -> DataFrame:
    """(folder, file_path): of the files below path whose name matches, the first by path in each folder."""
    files = spark.read.format("binaryFile").load(path, recursiveFileLookup=True, pathGlobFilter=pattern).select(F.col("path").alias("file_path"))
    if media_only:
        files = files.where(~F.lower(F.regexp_extract("file_path", "(\\.[^./]+)$", 1)).isin(*NOT_MEDIA))
    folder = F.regexp_extract("file_path", "([^/]+)/[^/]+$", 1)
    return files.groupBy(folder.alias("folder")).agg(F.min("file_path").alias("file_path"))


def source_list(spark: SparkSession, ids: list[str]) -> DataFrame:
    """source_ord and video_id of a given list; the order of the list is the order of the sources."""
    return spark.createDataFrame(list(enumerate(ids)), "source_ord int, video_id string")


def pending(units: DataFrame, done: DataFrame, key: str = "video_id") -> DataFrame:
    return units.join(done.select(key), key, "left_anti")


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def csv_rescued(spark: SparkSession, path: str, schema: str, work: Work, rescued: str = "rescued") -> tuple[DataFrame, DataFrame]:
    """(rows, rescued records) of a CSV table with a header. A record with too few or too many fields, or with one that its type
    cannot hold, is no row: its text is kept as the one column `rescued`. Records are single lines here, so that a quote that is
    never closed costs one record and not the rest of a file. What is parsed is written once, for both to read."""
    wide = f"{schema}, {rescued} string"
    every = spark.read.schema(wide).csv(path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=rescued, escape='"', encoding="UTF-8", enforceSchema=True)
    every = work.save(every, "parsed")
    return every.where(F.col(rescued).isNull()).drop(rescued), every.where(F.col(rescued).isNotNull()).select(rescued)


def caption_events_rescued(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """caption_events() for documents of any shape: (events, failures(video_id, event_index, reason, rescued)).

    Documents are read as VARIANT, so a field of the wrong type costs its event alone. A document that is no JSON, or has no array
    of events, is a failure without an event_index; an event is one if it is no object, its start or duration is no number, or
    its segments are no array. Absent starts, durations and texts are zero and empty, as there."""
    docs = documents.select("video_id", "content", F.try_parse_json("content").alias("doc"))
    kind = lambda v: F.schema_of_variant(v)
    events = F.try_variant_get("doc", "$.events", "variant")
    docs = docs.select("video_id", "content", F.col("doc").isNull().alias("broken"), F.coalesce(F.try_variant_get("doc", "$.events", "array<variant>"), F.lit(None)).alias("events"), F.when(events.isNotNull(), kind(events)).alias("kind"))
    lost = docs.where(F.col("events").isNull()).select("video_id", F.lit(None).cast("int").alias("event_index"), F.when(F.col("broken"), "NOT_JSON").otherwise("NO_EVENTS").alias("reason"), F.col("content").alias("rescued"))
    rows = docs.where(F.col("events").isNotNull()).select("video_id", F.posexplode("events").alias("event_index", "e"))
    get = lambda path, t: F.try_variant_get("e", path, t)
    there = lambda path: get(path, "variant").isNotNull() & ~F.coalesce(F.is_variant_null(get(path, "variant")), F.lit(False))
    time_ok = lambda path: ~there(path) | (get(path, "double").isNotNull() & ~kind(get(path, "variant")).isin("STRING", "BOOLEAN"))
    reason = (
        F.when(F.col("e").isNull() | ~kind(F.col("e")).startswith("OBJECT"), "NOT_OBJECT")
        .when(~time_ok("$.tStartMs"), "BAD_START")
        .when(~time_ok("$.dDurationMs"), "BAD_DURATION")
        .when(there("$.segs") & get("$.segs", "array<variant>").isNull(), "BAD_SEGMENTS")
    )
    rows = rows.withColumn("reason", reason)
    bad = rows.where("reason is not null").select("video_id", "event_index", "reason", F.to_json("e").alias("rescued"))
    said = lambda s: F.coalesce(F.try_variant_get(s, "$.utf8", "string"), F.lit(""))
    raw = F.array_join(F.transform(get("$.segs", "array<variant>"), said), "")
    ms = lambda path: F.coalesce(get(path, "double"), F.lit(0.0))
    good = rows.where("reason is null").select(
        "video_id",
        "event_index",
        (ms("$.tStartMs") / 1000).alias("start_sec"),
        ((ms("$.tStartMs") + ms("$.dDurationMs")) / 1000).alias("end_sec"),
        (ms("$.dDurationMs") / 1000).alias("duration_sec"),
        F.coalesce(raw, F.lit("")).alias("raw_text"),
    )
    good = good.withColumn("text", tx.clean(F.col("raw_text"))).where("text <> ''")
    return good.withColumn("ends_terminal_punctuation", tx.is_terminal(F.col("text"))), lost.unionByName(bad)
