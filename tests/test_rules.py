"""Rule lines, files, snapshots and errors."""

import pytest
from pyspark.sql import functions as F

from sparkscan import RuleError, check_rules, exclude_rules, rule_list, rules_table, scan, union_rules
from sparkscan.operators.rules import RULES_SCHEMA, collect_rules, parse_line, som_horizon, Rule
from sparkscan.sources.rule_files import format_rules, load_rules, load_snapshot, parse_rules, save_snapshot, snapshot_info, store_rules

LINES = [
    ("test", "test", "", {}),
    ("/test/", "test", "", {}),
    ("/test/i", "test", "i", {}),
    ("3:/test/i", "test", "i", {}),
    ("1:/hatstand.*teakettle/s{min_offset=50,max_offset=100}", "hatstand.*teakettle", "s", {"min_offset": 50, "max_offset": 100}),
    ("test/i", "test/i", "", {}),
    ("/t/e/s/t/i", "t/e/s/t", "i", {}),
    ("http://x", "http://x", "", {}),
    ("/a{2}/", "a{2}", "", {}),
    ("/a/i{}", "a", "i", {}),
]


@pytest.mark.parametrize("line, expression, flags, ext", LINES)
def test_line_on_driver(line, expression, flags, ext):
    rule = parse_line(line)
    assert (rule.expression, rule.flags, rule.ext) == (expression, frozenset(flags), ext)


def test_lines_as_table_agree_with_driver(spark):
    df = spark.createDataFrame([(i, line) for i, (line, *_) in enumerate(LINES)], "ord int, line string")
    got = collect_rules(parse_rules(df))
    assert [(r.pattern_id, r.expression, r.flags, r.ext) for r in got] == [
        (r.pattern_id, r.expression, r.flags, r.ext) for r in (parse_line(line, i) for i, (line, *_) in enumerate(LINES))
    ]


def test_flags_and_errors(spark):
    assert parse_line("/a/ism").flags == frozenset("ism")
    for bad in ("/a/test", "/a/i{depth=1}", "/a/i{min_offset=x}"):
        with pytest.raises(RuleError):
            parse_line(bad)
        with pytest.raises(Exception, match="cannot read"):
            parse_rules(spark.createDataFrame([(4, bad)], "ord int, line string")).collect()
    with pytest.raises(RuleError):
        parse_line("/a/s", kind="literal")


@pytest.mark.parametrize("bad", ["(", "a*", r"(a)\1", "a(?=b)", "[z-a]", r"\Ka"])
def test_unusable_rules_name_their_position(bad):
    with pytest.raises(RuleError, match="rule 1"):
        check_rules(rule_list(["ok", bad]))


def test_file_roundtrip(spark, tmp_path):
    source = tmp_path / "rules.txt"
    source.write_text("# rules\n1:/foo/\n2:/bar/\n\n  3:/google/i\n4:/github/i\nplain\n/x y/sL{min_length=3,hamming_distance=1}\n")
    rules = load_rules(spark, str(source))
    assert [(r.ord, r.pattern_id, r.expression) for r in collect_rules(rules)] == [
        (0, 1, "foo"), (1, 2, "bar"), (2, 3, "google"), (3, 4, "github"), (4, 4, "plain"), (5, 5, "x y")]
    store_rules(rules, str(tmp_path / "out"))
    again = load_rules(spark, str(tmp_path / "out"))
    assert collect_rules(again) == collect_rules(rules)


def test_format(spark):
    line = "1:/hatstand.*teakettle/s{min_offset=50,max_offset=100}"
    assert [r.line for r in format_rules(rules_table(spark, [line])).collect()] == [line]
    # a bare expression that would read as something else is delimited
    assert [r.line for r in format_rules(rules_table(spark, [Rule(0, 0, "# x"), Rule(1, 1, "/a/")])).orderBy("ord").collect()] == ["/# x/", "//a//"]


def test_snapshot(spark, tmp_path):
    rules = rules_table(spark, ["/foo(bar)+/iL"])
    save_snapshot(rules, str(tmp_path), version=3)
    loaded = load_snapshot(spark, str(tmp_path), version=3)
    df = spark.createDataFrame([(1, "hello foobar!")], "doc_id long, text string")
    assert [tuple(r) for r in scan(df, loaded).collect()] == [(1, 0, 6, 12)]
    a, b = snapshot_info(rules).first(), snapshot_info(loaded).first()
    assert a == b and a.rules == 1 and a.kinds == ["regex"]


def test_union_and_exclude(spark):
    both = union_rules(rules_table(spark, ["5:/a/", "b"]), rules_table(spark, ["c"]))
    assert [(r.ord, r.pattern_id, r.expression) for r in collect_rules(both)] == [(0, 5, "a"), (1, 1, "b"), (2, 0, "c")]
    left = exclude_rules(both, spark.createDataFrame([(1,)], "pattern_id int"))
    assert left.schema == RULES_SCHEMA and [r.expression for r in collect_rules(left)] == ["a", "c"]


def test_inputs_give_the_same_rules(spark):
    want = rule_list(["/a/i", "b"])
    assert rule_list([{"expression": "a", "flags": "i"}, {"expression": "b"}]) == want
    assert rule_list(rules_table(spark, ["/a/i", "b"])) == want
    assert rule_list(want) == want


def test_horizon():
    assert som_horizon([Rule(0, 0, "a")]) is None
    assert som_horizon([Rule(0, 0, "a", frozenset("L"))]) == "medium"
    assert som_horizon([Rule(0, 0, "a", frozenset("L"), som="small"), Rule(1, 1, "a", frozenset("L"), som="large")]) == "large"
