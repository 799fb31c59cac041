import pytest
from pyspark.sql import functions as F

from tessera import avg_distinct_word_length, distinct_word_count, doc_term_counts, lines, tokenize
from tessera import word_count, word_count_partitioned, word_count_report, word_count_salted
from tessera.functions.text import char_length, split_lines, split_words
from tests.conftest import SF_SMALL


def words_of(spark, line):
    return spark.createDataFrame([(line,)], "s STRING").select(split_words(F.col("s")).alias("w")).first().w


@pytest.mark.parametrize(
    "line,expected",
    [
        ("a b", ["a", "b"]),
        ("a  b ", ["a", "", "b"]),
        (" a", ["", "a"]),
        ("", [""]),
        ("  ", []),
        ("a\tb", ["a\tb"]),
        ("A a,", ["A", "a,"]),
    ],
)
def test_tokens_follow_java_split(spark, line, expected):
    assert words_of(spark, line) == expected


@pytest.mark.parametrize(
    "text,expected",
    [("a\nb\n", ["a", "b"]), ("a\n\n", ["a", ""]), ("a\r\nb", ["a", "b"]), ("", []), ("a\rb\r\n", ["a", "b"])],
)
def test_lines(spark, text, expected):
    got = spark.createDataFrame([(text,)], "t STRING").select(split_lines(F.col("t")).alias("l")).first().l
    assert got == expected


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")


def test_word_count_small_case(spark):
    docs = _docs(spark, ["x yy x\nyy zzz"])
    counts = {r.word: r.n for r in word_count(docs).collect()}
    assert counts == {"x": 2, "yy": 2, "zzz": 1}
    assert distinct_word_count(word_count(docs)).first()[0] == 3
    assert avg_distinct_word_length(word_count(docs)).first()[0] == 2.0


def test_empty_input_gives_null_mean(spark):
    docs = _docs(spark, [""])
    assert word_count(docs).count() == 0
    assert avg_distinct_word_length(word_count(docs)).first()[0] is None


def test_three_strategies_agree(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    a = word_count(docs)
    for other in (word_count_salted(docs, salts=5, seed=3), word_count_partitioned(docs, parts=3)):
        assert a.exceptAll(other).count() == 0
        assert other.exceptAll(a).count() == 0
    rep = word_count_report(docs).collect()
    assert len({(r.distinct_words, r.avg_length) for r in rep}) == 1


def test_salt_does_not_change_counts_on_a_hot_word(spark):
    docs = _docs(spark, ["hot " * 500 + "cold"] * 20)
    got = {r.word: r.n for r in word_count_salted(docs, salts=7).collect()}
    assert got == {"hot": 10000, "cold": 20}


def test_utf16_length_units(spark):
    df = spark.createDataFrame([("😀x",)], "word STRING")
    row = df.select(char_length(F.col("word")).alias("c"), char_length(F.col("word"), "utf16").alias("u")).first()
    assert (row.c, row.u) == (2, 3)


def test_doc_term_counts_and_tokenize_positions(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "b")], "doc_id BIGINT, text STRING")
    tf = {(r.doc_id, r.word): r.tf for r in doc_term_counts(df).collect()}
    assert tf == {(1, "a"): 2, (1, "b"): 1, (2, "b"): 1}
    toks = tokenize(lines(df), "line", keep=("doc_id", "line_no")).orderBy("doc_id", "pos").collect()
    assert [(r.doc_id, r.pos, r.word) for r in toks] == [(1, 0, "a"), (1, 1, "b"), (1, 2, "a"), (2, 0, "b")]


def test_spread_only_when_asked(spark):
    from tessera import spread

    one = spark.range(0, 1000, 1, 1)
    assert spread(one) is one
    assert spread(one, parts=3).rdd.getNumPartitions() == 3
    assert sorted(r.id for r in spread(one, 3).collect()) == list(range(1000))


def test_spread_pieces_do_not_grow_with_the_table(spark, tmp_path):
    from tessera import spread

    texts = [" ".join(f"{i * 7919 % 10007}w{k}" for k in range(i % 40)) for i in range(3000)]
    path = str(tmp_path / "documents.parquet")
    _docs(spark, texts).coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "documents.parquet").glob("*.parquet"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 8))
    try:
        for df in (docs, docs.select("text")):
            pieces = spread(df, 3).rdd.glom().map(len).collect()
            assert len(pieces) >= 8 and len(pieces) % 3 == 0 and sum(pieces) == 3000 and max(pieces) - min(pieces) <= len(pieces)
        want = sorted(map(tuple, word_count(docs).collect()))
        assert sorted(map(tuple, word_count_partitioned(docs, parts=3).collect())) == want
        assert {r.distinct_words for r in word_count_report(docs, parts=3).collect()} == {len(want)}
        # Tables of unknown size stay in as many parts as asked for.
        assert spread(_docs(spark, texts), 3).rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert spread(docs, 3).rdd.getNumPartitions() == 3


def test_report_in_utf16_units(spark):
    docs = _docs(spark, ["\U0001f600 b"])
    assert {r.avg_length for r in word_count_report(docs, units="utf16").collect()} == {1.5}
