"""Exact deduplication by deterministic block naming.

The normalised text of a document is cut into fixed-size blocks. All distinct blocks of the corpus are
sorted and numbered, so that equal blocks, and no others, share an integer name. Then adjacent names are
paired and the distinct pairs are sorted and numbered again, level by level, until each document has one
name. Names are given to compared values and never to hashes, so two documents share an identity only if
their normalised texts are equal.

Only DataFrame operations are used. The block texts are shuffled once, already distinct within each map
task. To hand a block's name back to its occurrences without moving the text again, a pair of 64-bit
hashes serves as a lookup key after it has been shown to be one-to-one on this corpus; if it were not, new
seeds are tried. Every level's tables are written to the shared folder. A document of n blocks takes part
in log2(n) levels, and each level halves the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Work

#: Characters that do not count when texts are compared: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
BLOCK = 4096
SEED_TRIES = 8


def without_spaces(text: Column) -> Column:
    for c in SPACES:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def blocks_of(text: Column, size: int) -> Column:
    """Consecutive blocks of size code points, the last may be shorter; an empty text has one empty block."""
    return F.when(F.length(text) <= size, F.array(text)).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    )


def lookup_key(block: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * seed), block), F.xxhash64(F.lit(2 * seed + 1), block)]


def numbered(values: DataFrame, *by: str) -> DataFrame:
    """Adds an integer name to each row of a table of distinct rows, in sorted order within its partitions.

    The sort makes the numbers a function of a partition's content, so that a task that is run again after
    the loss of an executor gives the same ones.
    """
    return values.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def block_names(docs: DataFrame, work: Work, block: int, key=lookup_key) -> tuple[DataFrame, int]:
    """Names of all distinct blocks by lookup key (k1, k2, name), and the seed for which that key is one-to-one."""
    for seed in range(SEED_TRIES):
        distinct = docs.select(F.explode(blocks_of(F.col("norm"), block)).alias("block")).distinct()
        k1, k2 = key(F.col("block"), seed)
        names = work.save(numbered(distinct, "block").select(k1.alias("k1"), k2.alias("k2"), "name"), f"names{seed}")
        if names.groupBy("k1", "k2").count().where("count > 1").isEmpty():
            return names, seed
        work.drop(f"names{seed}")
    raise ValueError("no seed gave a one-to-one lookup key for the blocks")


def identities(docs: DataFrame, work: Work, block: int = BLOCK, key=lookup_key) -> DataFrame:
    """One row per row of docs(doc_id, text): rid, doc_id, chars, sha, level, name; equal (level, name): equal texts."""
    norm = docs.select("doc_id", F.length("text").alias("chars"), without_spaces(F.col("text")).alias("norm"))
    names, seed = block_names(norm, work, block, key)
    meta = work.save(
        norm.select(
            F.monotonically_increasing_id().alias("rid"),
            "doc_id",
            "chars",
            F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"),
            F.transform(
                blocks_of(F.col("norm"), block),
                lambda b: F.struct(*(k.alias(n) for n, k in zip(("k1", "k2"), key(b, seed), strict=True))),
            ).alias("keys"),
        ),
        "meta",
    )
    rows = meta.select("rid", F.size("keys").alias("n"), F.posexplode("keys").alias("i", "key"))
    rows = rows.select("rid", "n", "i", F.col("key.k1").alias("k1"), F.col("key.k2").alias("k2"))
    rows = work.save(rows.join(names, ["k1", "k2"]).select("rid", "n", "i", "name"), "level0")
    most = rows.agg(F.max("n")).first()[0] or 1
    ended, level = [rows.where("n = 1").select("rid", F.lit(0).alias("level"), "name")], 0
    while most > 1:
        level, most = level + 1, (most + 1) // 2
        even = F.col("i") % 2 == 0
        pairs = (
            rows.where("n > 1")
            .groupBy("rid", F.shiftright("i", 1).alias("half"))
            .agg(
                F.shiftright(F.max("n") + 1, 1).alias("n"),
                F.max(F.when(even, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"),
            )
        )
        pairs = work.save(pairs.withColumnRenamed("half", "i"), f"pairs{level}")
        names = work.save(numbered(pairs.select("a", "b").distinct(), "a", "b"), f"names_at{level}")
        rows = work.save(pairs.join(names, ["a", "b"]).select("rid", "n", "i", "name"), f"level{level}")
        work.drop(f"pairs{level}", f"names_at{level}")
        ended.append(rows.where("n = 1").select("rid", F.lit(level).alias("level"), "name"))
    done = ended[0]
    for more in ended[1:]:
        done = done.unionByName(more)
    found = work.save(meta.drop("keys").join(done, "rid"), "identities")
    work.drop("meta", f"names{seed}", *(f"level{k}" for k in range(level + 1)))
    return found


def exact_dedup(docs: DataFrame, block: int = BLOCK, key=lookup_key) -> DataFrame:
    """Groups the rows of docs whose texts are equal after deleting spaces and control spaces.

    docs: doc_id, text and any other columns, which are ignored. Returns one row per input row: doc_id, keep_id,
    group_size, kept, text_sha256 (of the normalised text in UTF-8), level and name (the identity). The row
    with the most code points in its original text stays, then the smallest doc_id (null last), then one of
    the rows that are alike in both.

    Nulls: a null text is an empty text, and all empty texts are one group; a null doc_id is an id of its own
    kind, sorted last. Repeated rows form a group of which one row stays. An empty table gives no rows.
    """
    work = Work(docs.sparkSession, "exact")
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = identities(rows, work, block, key)
    best = F.min(F.struct(-F.col("chars"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("rid")))
    groups = work.save(
        found.groupBy("level", "name")
        .agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
        .select("level", "name", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.rid").alias("keep_rid")),
        "groups",
    )
    # Both sides are written tables, so that a hot group is a skewed partition which Spark splits by itself.
    return found.join(groups, ["level", "name"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("rid") == F.col("keep_rid")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "level",
        "name",
    )


EXACT_DEDUP_SQL = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents
), k AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST) = 1 AS kept
  FROM d
)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM k
"""
