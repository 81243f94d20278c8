"""Steps that may fail on single rows: failures are caught row by row, counted while the rows are written, and fail the run at
its end, when what succeeded is safe."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Columns that an attempt adds besides those of the step.
OUTCOME = ("ok", "error_type", "error")


@dataclass
class FailedRows(RuntimeError):
    """More rows failed than the run allows, or the written rows are not those that were counted. Successes are written."""

    attempted: int
    succeeded: int
    failed: int
    written: int

    def __str__(self) -> str:
        return f"{self.failed} of {self.attempted} rows failed, {self.written} are written"


def _schema(rows: DataFrame, gives: str) -> T.StructType:
    return T.StructType([*rows.schema.fields, *T.StructType.fromDDL(gives).fields, *T.StructType.fromDDL("ok boolean, error_type string, error string").fields])


def attempted_rows(rows: DataFrame, step: Callable[[dict], dict], needs: list[str], gives: str) -> DataFrame:
    """rows with the columns of `gives` (a schema, which names none of theirs) that step(row of the columns `needs`) returns, and ok,
    error_type and error of what it raised. Only `needs` become Python objects; the others pass through as Arrow columns. A value
    that its type cannot hold is a failure of its row."""
    new, both = T.StructType.fromDDL(gives), _schema(rows, gives)
    types = [to_arrow_type(f.dataType) for f in new.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inputs = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in needs]
            values: list[list] = [[] for _ in new.fields]
            outcome: list[list] = [[], [], []]
            for one in zip(*inputs, strict=True):
                try:
                    found = step(dict(zip(needs, one, strict=True)))
                    kept, why = [pa.scalar(found.get(f.name), t).as_py() for f, t in zip(new.fields, types, strict=True)], (True, None, None)
                except Exception as e:
                    kept, why = [None] * len(types), (False, type(e).__name__, str(e))
                for column, v in zip(values, kept, strict=True):
                    column.append(v)
                for column, v in zip(outcome, why, strict=True):
                    column.append(v)
            columns = [pa.array(v, t) for v, t in zip(values, types, strict=True)] + [pa.array(v, t) for v, t in zip(outcome, (pa.bool_(), pa.string(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], both.names)

    return rows.mapInArrow(run, both)


def run_isolated(rows: DataFrame, step: Callable[[dict], dict], needs: list[str], gives: str, path: str, allowed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Attempts the step on all rows in one pass, writes successes and failures to path in one commit, and returns both.

    Attempts, successes and failures are counted by the write itself (observed metrics). If more than `allowed` rows failed, or
    the written table has not as many of each, FailedRows is raised; the table is there by then and can be read with outcomes().
    """
    seen = Observation("attempts")
    tried = attempted_rows(rows, step, needs, gives)
    counted = tried.observe(seen, F.count(F.lit(1)).alias("attempted"), F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"))
    counted.write.mode("errorifexists").partitionBy("ok").parquet(path)
    good, bad = outcomes(rows, gives, path)
    n, written = seen.get, {True: good.count(), False: bad.count()}
    if n["failed"] > allowed or n["succeeded"] != written[True] or n["failed"] != written[False]:
        raise FailedRows(n["attempted"], n["succeeded"], n["failed"], sum(written.values()))
    return good, bad


def outcomes(rows: DataFrame, gives: str, path: str) -> tuple[DataFrame, DataFrame]:
    """The successes (rows' columns and the step's) and the failures (rows' columns, error_type, error) of a written attempt."""
    every = rows.sparkSession.read.schema(_schema(rows, gives)).parquet(path)
    given = [c for c in every.columns if c not in OUTCOME]
    return every.where("ok").select(*given), every.where("not ok").select(*rows.columns, "error_type", "error")
