"""Line and word splitting against a brute-force model of the Java semantics."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions.text import split_lines, split_words


def java_split_space(s: str) -> list[str]:
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def text_lines(s: str) -> list[str]:
    if s == "":
        return []
    parts = re.split(r"\r\n|\n|\r", s)
    if s[-1] in "\r\n":
        parts.pop()
    return parts


texts = st.lists(st.text(alphabet="ab \t\n\ré\U0001f600", max_size=12), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None)
@given(texts)
def test_split_matches_java(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i INT, t STRING")
    got = df.select("i", split_lines(F.col("t")).alias("ls"), split_words(F.col("t")).alias("ws")).collect()
    for r in got:
        assert r.ls == text_lines(xs[r.i])
        assert r.ws == java_split_space(xs[r.i])
