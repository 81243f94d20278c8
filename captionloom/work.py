"""Tables that one query writes and reads again, below the folder that the session shares with its executors."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: monotonically_increasing_id() has the partition above these bits and the row within it below.
ROW_BITS = 33


class Work:
    """A folder of this run below the shared folder that the session names.

    Intermediate tables are written there and read again, so that lineage is cut by files which every executor can
    read and a lost executor costs no recomputation. Where a session of local mode names no folder, this process makes
    one of its own; on a cluster that is an error, as other machines would not see it. Tables stay as long as the application
    runs, since results are read from them; when it ends, its folders are deleted.
    """

    own: str | None = None
    made: list["Work"] = []

    def __init__(self, spark: SparkSession, label: str):
        base = spark.conf.get(CHECKPOINT_DIR, None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError(f"{CHECKPOINT_DIR} has to name a folder that all executors share")
            Work.own = base = Work.own or tempfile.mkdtemp(prefix="captionloom-")
        self.spark = spark
        self.path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
        if not Work.made:
            atexit.register(Work.clear)
        Work.made.append(self)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Writes df and returns the written table. The shuffle files of the write are deleted with it, as nothing reads them
        again; otherwise they stay until the driver happens to collect the plan. While it writes, the option for that is set for
        the whole session: queries that run beside it in other threads lose theirs too, and compute them again if they need to."""
        conf, before = self.spark.conf, self.spark.conf.get(SHUFFLE_CLEANUP, "false")
        conf.set(SHUFFLE_CLEANUP, "true")
        try:
            df.write.mode("overwrite").parquet(f"{self.path}/{name}")
        finally:
            conf.set(SHUFFLE_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        """Deletes tables that nothing reads any more."""
        for name in names:
            self._delete(f"{self.path}/{name}")

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    @staticmethod
    def clear() -> None:
        """Deletes the folders of all runs of this application. A session that has ended by then leaves its own."""
        while Work.made:
            work = Work.made.pop()
            with contextlib.suppress(Exception):
                work._delete(work.path)


def numbered(rows: DataFrame, order: list[Column | str], name: str, work: Work) -> DataFrame:
    """Adds the place (from 0) of each row in a total order. Rows are dealt by ranges of the order and sorted there; a
    place is the number of rows in the ranges before, one number for each range, and the place within the own one."""
    placed = work.save(rows.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), f"numbered_{name}")
    part = F.shiftright("_id", ROW_BITS)
    before, total = [], 0
    for r in sorted(placed.groupBy(part.alias("part")).count().collect()):
        before.append((r.part, total))
        total += r["count"]
    first = F.broadcast(work.spark.createDataFrame(before, "_part long, _first long"))
    place = F.col("_first") + F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return placed.withColumn("_part", part).join(first, "_part").withColumn(name, place).drop("_part", "_first", "_id")
