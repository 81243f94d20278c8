"""Explicit schemas of the stage tables, and checks of columns on entry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JSON3 = "events array<struct<tStartMs:double,dDurationMs:double,segs:array<struct<utf8:string>>>>"
CAPTION_EVENTS = "video_id string, event_index int, start_sec double, end_sec double, duration_sec double, text string"
ASR_SEGMENTS = (
    "video_id string, segment_id int, start_sec double, end_sec double, duration_sec double, text string,"
    " avg_logprob double, no_speech_prob double, compression_ratio double"
)
ASR_WORDS = (
    "video_id string, segment_id int, word_index int, word string, start_sec double, end_sec double,"
    " duration_sec double, gap_before_sec double, probability double"
)
SENTENCE_UNITS = (
    "video_id string, sentence_id string, start_sec double, end_sec double, first_event_index int,"
    " last_event_index int, text string, char_count int, word_count int, boundary_basis string"
)
TASK = (
    "task_id string, blocks array<struct<block_id:string,parent_block_id:string,video_id:string,"
    "source_start_sec:double,source_text:string>>"
)
LABEL_RESULT = "task_id string, blocks array<struct<block_id:string,segments:array<struct<text_exact:string,label:string,reason_short:string>>>>"


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def numbers(df: DataFrame, *names: str) -> DataFrame:
    """Columns as doubles; what is no number, or NaN, is null."""
    for name in names:
        value = F.col(name).try_cast("double")
        df = df.withColumn(name, F.when(~F.isnan(value), value))
    return df
