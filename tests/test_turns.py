"""Turns that only begin alike are no duplicates."""

from captionloom.plans import registry


def test_consecutive_dups_compare_whole_turns(spark, tmp_path):
    texts = ["the same beginning, one end", "The same beginning: another end", "the same beginning - another end!", "other"]
    rows = [(1, k, "user", t) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    (row,) = registry.consecutive_dups(spark, str(tmp_path)).collect()
    assert (row.consecutive, row.unique_ratio) == (1, 0.75)
