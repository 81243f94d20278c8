"""Text functions against literal vectors and small Python models."""

import html
import html.entities
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from captionloom.functions import similarity as si
from captionloom.functions import text as tx


def one(spark, column, **values):
    names = list(values)
    return spark.createDataFrame([tuple(values.values())], names).select(column.alias("x")).first().x


def test_split_is_lossless(spark):
    found = one(spark, tx.split_pieces(F.col("t")), t="A b. 3.5 c!” d… e")
    assert [r.piece for r in found] == ["A b.", "3.5 c!”", "d…", "e"]
    assert [("A b. 3.5 c!” d… e")[r.char_start : r.char_end] for r in found] == [r.piece for r in found]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab .!?…”\n", max_size=30), min_size=1, max_size=20))
def test_split_keeps_everything(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.split_pieces(F.col("t")).alias("p"))
    squeeze = lambda x: re.sub(r"\s+", " ", x).strip()
    for r in df.collect():
        assert squeeze(" ".join(p.piece for p in r.p)) == squeeze(r.t)
        assert all(r.t[p.char_start : p.char_end] == p.piece for p in r.p)


def test_complete_sentences_drop_the_tail(spark):
    assert one(spark, tx.complete_sentences(F.col("t")), t="Alpha 3.5 beta. Gamma!” delta tail") == ["Alpha 3.5 beta.", "Gamma!”"]


def test_joins(spark):
    assert one(spark, tx.join_events(F.split("t", "\\|")), t="Hi|there|, you|!") == "Hi there, you!"
    assert one(spark, tx.join_words(F.split("t", "\\|")), t="( |a|, b| ) |c") == "(a, b) c"


@pytest.mark.parametrize("seconds,label", [(0.0, "00:00:00.000"), (-3.0, "00:00:00.000"), (3661.5, "01:01:01.500")])
def test_hms(spark, seconds, label):
    assert one(spark, tx.hms(F.col("s")), s=seconds) == label


def test_clean_keeps_line_feeds(spark):
    assert one(spark, tx.clean(F.col("t")), t=" a\t\tb &amp; c\n d​ ") == "a b & c\n d"
    assert one(spark, tx.clean(F.col("t")), t="&eacute;&#233;") == "éé"


def test_hints(spark):
    assert one(spark, tx.repeated_token(F.col("t")), t="so So, fine")
    assert not one(spark, tx.repeated_token(F.col("t")), t="so it so")
    assert one(spark, tx.crowded_initials(F.col("t")), t="ba be bi bo la")
    assert not one(spark, tx.crowded_initials(F.col("t")), t="ba be la bi lo")


@pytest.mark.parametrize("a,b,value", [("a b c d", "b c a d", 0.75), ("x y", "y x", 0.5), ("", "", 1.0), ("x", "", 0.0)])
def test_similarity(spark, a, b, value):
    cols = tx.lexical_tokens(F.col("a")), tx.lexical_tokens(F.col("b"))
    assert one(spark, si.token_similarity(*cols), a=a, b=b) == pytest.approx(value)
    df = spark.createDataFrame([(1, a, b)], "n int, a string, b string")
    assert si.multiset_similarity(df, ["n"], *cols, "bound").first().bound >= value - 1e-12


def test_unescape_equals_the_library(spark):
    rng = random.Random(12)
    bits = ["&", "&amp;", "&lt", "&nbsp;", "&#x27;", "&#39", "&#128;", "&#x81;", "&#0;", "&#xD800;", "&#x110000;", "&#99999999999;", "&#11;", "&#xFDD0;", "&#x1F600;", "&#x1ffff;", "&notit;", "&noti", "&CounterClockwiseContourIntegral;"]
    bits += ["&acE;", "&x;", "&é;", "& ", "&#;", "&#x;", "&#xg", ";", "a", "<", "#", "é汉", "&amp;lt;", "&thetasym", "&notin;x", "\n", "&#065;", "&#x000041", "&ampamp;", "&a" * 40, "&frac12", "&#12", "3;"]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 6))) for _ in range(1500)] + bits + [f"&{n}" for n in list(html.entities.html5)[::7]] + ["", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", tx.unescape(F.col("t")).alias("u"), F.transform(F.array("t"), tx.unescape).alias("l")).collect():
        want = None if r.t is None else html.unescape(r.t)
        assert r.u == want and r.l == [want], r.t


def test_entity_names_are_one_constant(spark, capsys):
    spark.range(1).select(tx.unescape(F.col("id").cast("string")).alias("x")).explain("extended")
    optimized = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1]
    assert "str_to_map" not in optimized
