"""Digit spellings read as letters in a shadow text of equal length; evidence keeps the original wording."""

from pyspark.sql import functions as F

from sievemark.functions.text import digits_as_letters, original_wording
from sievemark.operators.screen import ScreenConfig, screen_explicit
from sievemark.packs.neutral import NEUTRAL


def test_shadow_text_and_wording(spark):
    rows = [("You 1d10t, born 2013!",), ("m0r0n and MORON",), (None,), ("",)]
    df = spark.createDataFrame(rows, "text string")
    got = df.select(digits_as_letters(F.col("text")).alias("s")).collect()
    assert [r.s for r in got] == ["You idiot, born 2013!", "moron and MORON", None, ""]
    back = df.select(original_wording(F.col("text"), F.lit("idiot")).alias("w")).collect()
    assert back[0].w == "1d10t" and back[2].w == "idiot"


def test_screening_with_and_without_the_option(spark):
    df = spark.createDataFrame([(1, "what an 1d10t"), (2, "what an idiot"), (3, "call 1234 now")], "doc_id long, text string")
    plain = {r.doc_id: r for r in screen_explicit(df, NEUTRAL).select("doc_id", "explicit.*").collect()}
    spelled = {
        r.doc_id: r
        for r in screen_explicit(df, NEUTRAL, ScreenConfig(digit_spellings=True)).select("doc_id", "explicit.*").collect()
    }
    assert not plain[1].is_explicit and plain[2].is_explicit
    assert spelled[1].is_explicit and spelled[1].matched_keywords == ["1d10t", "1d10t"]
    assert spelled[2].matched_keywords == ["idiot", "idiot"] and not spelled[3].is_explicit
