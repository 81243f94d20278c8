"""What the operators of this subpackage share: the shared work folder, saved tables, safe column access."""

from __future__ import annotations

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from captionloom.work import Work

__all__ = ["Work", "crc_fold", "pieces", "pieces_by_size", "table", "texts"]


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (null: empty) alone, with the columns asked for; other columns cannot clash."""
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as decimal text, modulo folds; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def pieces(batches, rows: int = 256):
    """Arrow record batches cut into smaller ones, so that few texts at a time become Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def pieces_by_size(batches, column: int, rows: int = 256, most_bytes: int = 4_000_000):
    """As pieces(), with at most most_bytes of text in a column at a time, but for a single longer one."""
    for batch in pieces(batches, rows):
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for k, size in enumerate(sizes):
            if k > start and held + size > most_bytes:
                yield batch.slice(start, k - start)
                start = k
                held = 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
