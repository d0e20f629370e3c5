"""Exact offsets the rules are documented to give."""

import pytest
from pyspark.sql import functions as F

from sparkscan import Regex, Rule, pcre_scan, prepare, scan, scan_one, stream_scan, vectored_scan
from sparkscan.operators.rules import single
from sparkscan.streaming.batch import carry, fork, resume, rewind

from .helpers import rows

CHUNKS = "stream_id long, seq long, payload string"
CONTROL = CHUNKS + ", control string"


def one(spark, text):
    return spark.createDataFrame([(1, text)], "doc_id long, text string")


@pytest.mark.parametrize(
    "rule, text, want",
    [
        ("/test/iL", "some test data", [(5, 9)]),
        ("/test/iL", "foo test bar", [(4, 8)]),
        ("/foo(bar)?/i", "hello foobar!", [(0, 9), (0, 12)]),
        ("/foo(bar)+/iL", "hello foobar!", [(6, 12)]),
    ],
)
def test_block(spark, rule, text, want):
    assert [r[2:] for r in rows(scan(one(spark, text), rule))] == want


def test_vectored(spark):
    df = spark.createDataFrame([(1, ["foo", "test", "bar"])], "doc_id long, chunks array<string>")
    assert rows(vectored_scan(df, "/test/iL")) == [(1, 0, 3, 7)]


def test_stream_chunks_of_4096(spark):
    text = "x" * 4094 + "baaab"
    chunks = spark.createDataFrame([(1, 0, text[:4096]), (1, 1, text[4096:])], CHUNKS)
    assert [r[2:] for r in rows(stream_scan(chunks, "/a+/L"))] == [(4095, 4096), (4095, 4097), (4095, 4098)]


def parts(spark, *texts, stream=1, start=0):
    return spark.createDataFrame([(stream, start + i, t) for i, t in enumerate(texts)], CHUNKS)


def test_stream_across_chunks(spark):
    assert rows(stream_scan(parts(spark, "foo t", "es", "t bar"), "/test/L")) == [(1, 0, 4, 8)]


def test_stream_reset(spark):
    data = [(1, 0, "foo t", None), (1, 1, "es", None), (1, 2, "t bar", None), (1, 3, None, "reset"),
            (1, 4, "foo t", None), (1, 5, "es", None), (1, 6, "t bar", None)]
    found = stream_scan(spark.createDataFrame(data, CONTROL), "/test/L", epochs=True)
    assert rows(found) == [(1, 0, 0, 4, 8), (1, 1, 0, 4, 8)]


def test_stream_reset_and_copy(spark):
    states = carry(parts(spark, "foo t", "es"), "/test/L")
    children = spark.createDataFrame([(2, 1)], "stream_id long, parent_id long")
    child = stream_scan(parts(spark, "test", stream=2), "/test/L")
    copied = stream_scan(fork(parts(spark, "t bar", stream=2), states, children), "/test/L")
    assert rows(child.unionByName(copied)) == [(2, 0, 0, 4), (2, 0, 4, 8)]


def test_stream_save_and_resume(spark):
    states = carry(parts(spark, "foo t", "es"), "/test/L")
    assert [tuple(r) for r in states.collect()] == [(1, 7, b"foo tes")]
    assert rows(stream_scan(resume(parts(spark, "t bar", start=2), states), "/test/L")) == [(1, 0, 4, 8)]


def test_stream_rewind(spark):
    states = carry(parts(spark, "foo t", "es"), "/test/L")
    chunks = parts(spark, "foo t", "es", "t bar", "t bar")
    assert rows(stream_scan(rewind(chunks, states, F.lit(3)), "/test/L")) == [(1, 0, 4, 8), (1, 0, 4, 8)]


def test_pcre(spark):
    assert rows(pcre_scan(one(spark, "hello foobar!"), "/foo(bar)?/i")) == [(1, 0, 6, 12)]
    assert rows(pcre_scan(one(spark, "some test data"), "/test/i")) == [(1, 0, 5, 9)]


def test_pcre_groups(spark):
    found = pcre_scan(one(spark, "some test data"), r"/(?<word>\w+)/i", groups=True).orderBy("from").collect()
    assert [(r["from"], r["to"]) for r in found] == [(0, 4), (5, 9), (10, 14)]
    for r in found:
        whole, word = r["captures"]
        assert (whole["from"], whole["to"], whole["text"]) == (word["from"], word["to"], word["text"])


def test_capture_offsets(spark):
    found = pcre_scan(one(spark, "k=ab, j=c;"), r"/(\w)=((a)(b)?|c)(x)*/", groups=True).orderBy("from").collect()
    caps = [[tuple(c) for c in r["captures"]] for r in found]
    assert caps[0] == [(0, True, 0, 4, "k=ab"), (1, True, 0, 1, "k"), (2, True, 2, 4, "ab"), (3, True, 2, 3, "a"),
                       (4, True, 3, 4, "b"), (5, False, None, None, "")]
    assert caps[1][:5] == [(0, True, 6, 9, "j=c"), (1, True, 6, 7, "j"), (2, True, 8, 9, "c"), (3, False, None, None, ""),
                           (4, False, None, None, "")]


def test_facade(spark):
    def value(text, column):
        return one(spark, text).select(column(F.col("text")).alias("v")).first()["v"]

    thirteen = Regex(r"\b\w{13}\b")
    text = "I categorically deny having triskaidekaphobia."
    assert value(text, thirteen.is_match) is True
    assert tuple(value(text, thirteen.find)) == (2, 15, "categorically")
    found = value("Retroactively relinquishing remunerations is reprehensible.", thirteen.find_iter)
    assert [m["text"] for m in found] == ["Retroactively", "relinquishing", "remunerations", "reprehensible"]
    assert value("a b \t  c\td    e", Regex(r"[ \t]+").split) == ["a", "b", "c", "d", "e"]
    splitter = Regex(r"\W+")
    assert value("Hey! How are you?", lambda c: splitter.splitn(c, 3)) == ["Hey", "How", "are you?"]
    assert value("Hey! How are you?", lambda c: splitter.splitn(c, 0)) == []
    parts_ = value("baaaab", Regex("a+").segments)
    assert [tuple(p) for p in parts_] == [("reject", 0, 1, "b"), ("match", 1, 5, "aaaa"), ("reject", 5, 6, "b")]
    assert [tuple(p) for p in value("bcd", Regex("a+").segments)] == [("reject", 0, 3, "bcd")]
    assert value("bcd", Regex("a+").find) is None


def test_widths():
    dated = prepare(r"(\d{4})-(\d{2})-(\d{2,4})")
    assert (dated.min_width, dated.max_width) == (10, 12)
    assert (prepare("test").min_width, prepare("test").max_width) == (4, 4)


def test_single_expression_reports_id_zero(spark):
    assert single("7:/a/")[0].pattern_id == 0
    assert rows(scan_one(one(spark, "ba"), "7:/a/L")) == [(1, 0, 1, 2)]
    assert rows(scan(one(spark, "ba"), [Rule(0, 7, "a", frozenset("L"))])) == [(1, 7, 1, 2)]
