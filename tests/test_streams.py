"""Streams: any cutting gives the same matches, in batch and live."""

import random

import pytest
from pyspark.sql import functions as F

from sparkscan import Rule, RuleError, scan, stream_scan
from sparkscan.operators.control import apply_horizon, handle_matches, handled_scan, single_match, skip_rule, terminate, within
from sparkscan.operators.numbering import running_before
from sparkscan.operators.ranking import hits_per_rule, rule_ranking
from sparkscan.operators.sessions import block_matches, boundary_matches, session_ids, sessionize
from sparkscan.plans import QUERIES
from sparkscan.plans.frame_input import encode_frames
from sparkscan.session import fresh_path, stored
from sparkscan.sources.documents import whole_files
from sparkscan.sources.frames import decode_frames
from sparkscan.streaming.batch import carry, chunks_of, resume, with_offsets
from sparkscan.streaming.live import live_scan, use_rocksdb

from .helpers import brute, rows

RULES = ["/a+b/L", "/^a/mL", "/a$/L", "/a$/mL", r"/\ba\b/L", "/c[^a]/L", r"/b\B/L", "/é.?/8L", r"/é\b/8WL"]
CHUNKS = "stream_id long, seq long, payload binary"


def cut(rng, data, widest):
    out = []
    while data:
        n = rng.randint(0, widest)
        out.append(data[:n])
        data = data[n:]
    return out


@pytest.fixture(scope="module")
def streams():
    rng = random.Random(11)
    return {k: "".join(rng.choice("ab c\né") for _ in range(rng.randint(0, 60))) for k in range(25)}


@pytest.fixture(scope="module")
def chunks(spark, streams):
    rng = random.Random(5)
    data = [(k, i, c) for k, t in streams.items() for i, c in enumerate(cut(rng, t.encode(), 5))]
    return spark.createDataFrame(data, CHUNKS).cache()


def expected(streams):
    want = []
    for k, text in streams.items():
        for i, line in enumerate(RULES):
            body, flags = line[1:].rsplit("/", 1)
            want += [(k, i, s, e) for e, s in brute(body, flags, text).items()]
    return sorted(want)


@pytest.mark.parametrize("size", [16, 100, 65_536])
def test_any_cutting_and_any_block(chunks, streams, size):
    assert rows(stream_scan(chunks, RULES, size=size)) == expected(streams)


def test_open_streams_hold_back_the_end(spark):
    df = spark.createDataFrame([(1, 0, b"xa")], CHUNKS)
    rules = ["/a/L", "/a$/L", r"/a\b/L", "/(x|xa$)/L"]
    assert rows(stream_scan(df, rules, close=False)) == [(1, 0, 1, 2), (1, 3, 0, 1)]
    assert rows(stream_scan(df, rules)) == [(1, 0, 1, 2), (1, 1, 1, 2), (1, 2, 1, 2), (1, 3, 0, 1), (1, 3, 0, 2)]
    control = df.withColumn("control", F.lit(None).cast("string")).unionByName(
        spark.createDataFrame([(1, 1, None, "close")], CHUNKS + ", control string"))
    assert rows(stream_scan(control, rules, close=False)) == rows(stream_scan(df, rules))


def test_saving_anywhere_changes_nothing(chunks, streams):
    before, after = chunks.where("seq < 4"), chunks.where("seq >= 4")
    rules = [r for r in RULES if "$" not in r and "\\b" not in r and "\\B" not in r]
    rules += ["/[ab]+c/L", "/a[^\\n]*c/L"]
    states = carry(before, rules)
    got = stream_scan(before, rules).unionByName(stream_scan(resume(after, states), rules))
    assert rows(got) == rows(stream_scan(chunks, rules))


def test_a_rewound_stream_goes_on_to_its_end(spark, tmp_path):
    texts = ["a tion", "xe", "er", "b", "tion er", "c ti", "on"]
    data = [(7, k, t) for k, t in enumerate(texts)] + [(8, 0, "tion"), (8, 1, "er")]
    spark.createDataFrame(data, "conv_id long, turn int, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    once = [(7, 0, 2, 6), (7, 1, 7, 10), (7, 0, 11, 15), (7, 1, 16, 18), (7, 0, 20, 24)]
    again = [m for m in once if m[3] > 8]
    got = rows(QUERIES["stream_rewind_whole"](spark, str(tmp_path)))
    assert got == sorted([*once, *again, (8, 0, 0, 4), (8, 1, 4, 6)])


def test_long_matches_of_unbounded_and_wide_rules(spark):
    text = b"a" + b"x" * 140_000 + b"b"
    data = spark.createDataFrame([(1, k, text[k * 30_000:(k + 1) * 30_000]) for k in range(5)], CHUNKS)
    rule = r"/^a[^\n]*b/L"
    assert rows(stream_scan(data, rule)) == [(1, 0, 0, 140_002)]
    states = carry(data.where("seq < 2"), rule)
    assert rows(stream_scan(resume(data.where("seq >= 2"), states), "/a[^\\n]*b/L")) == [(1, 0, 0, 140_002)]
    wide = spark.createDataFrame([(1, 0, b"x" + b"." * 100), (1, 1, b"." * 50 + b"y")], CHUNKS)
    assert rows(stream_scan(wide, "/x.{150}y/sL", size=64)) == [(1, 0, 0, 152)]
    assert rows(stream_scan(wide, f"/{'[.]' * 140}y/8L", size=64)) == [(1, 0, 11, 152)]


def test_single_match_over_a_stream(chunks, streams):
    got = rows(stream_scan(chunks, ["/a+b/HL", "/c/L"], size=16))
    want = []
    for k, text in streams.items():
        first = sorted((e, s) for e, s in brute("a+b", "", text).items())[:1]
        want += [(k, 0, s, e) for e, s in first] + [(k, 1, s, e) for e, s in brute("c", "", text).items()]
    assert got == sorted(want)


@pytest.mark.parametrize("size", [16, 65_536])
def test_unbounded_rules_are_exact_without_a_horizon(chunks, streams, size):
    rules = ["/a.*b/L", "/[ab]+c/L", r"/\bb[ab]*$/mL", "/^[abc ]+$/L", "/[ab]+/L", "/a.*c/HL"]
    want = []
    for k, text in streams.items():
        for i, line in enumerate(rules[:-1]):
            body, flags = line[1:].rsplit("/", 1)
            want += [(k, i, s, e) for e, s in brute(body, flags, text).items()]
        want += [(k, 5, s, e) for e, s in sorted(brute("a.*c", "", text).items())[:1]]
    assert rows(stream_scan(chunks, rules, size=size)) == sorted(want)


ANY_BYTE = ["/a.*b/sL", "/a.*b/s", "/é+b/8L", "/(é|ab).*(b|é)/8sL", "/c.*/8sL", r"/c.*\bb/sL", "/^.*b/msL", "/(b|abc).*c/sL", "/[^a]*b/L", "/é.*b/8sHL"]


def all_events(rules, texts):
    want = []
    for k, text in texts.items():
        for i, line in enumerate(rules):
            body, flags = line[1:].rsplit("/", 1)
            found = sorted((e, s if "L" in flags else 0) for e, s in brute(body, flags, text).items())
            want += [(k, i, s, e) for e, s in (found[:1] if "H" in flags else found)]
    return sorted(want)


@pytest.mark.parametrize("size", [16, 65_536])
def test_rules_that_may_hold_any_byte(chunks, streams, size):
    """Cut at their unbounded repeat: blocks far smaller than the matches, in bytes and in characters."""
    assert rows(stream_scan(chunks, ANY_BYTE, size=size)) == all_events(ANY_BYTE, streams)


def test_matches_over_many_blocks(spark):
    """Heads many blocks back, starts that vary near a block's edge, stretches that end in the context."""
    rng = random.Random(8)
    letters = ["ab c\né😀", "abc ", "aaab é😀", "é", "b\n", "é\nc"]
    texts = {k: "".join(rng.choice(letters[k % 6]) for _ in range(rng.randint(100, 250))) for k in range(6)}
    texts |= {20: "a" * 300, 21: "abc" * 90, 22: "d" + "é" * 150 + "b" + "é" * 90 + "b"}
    data = [(k, i, c) for k, t in texts.items() for i, c in enumerate(cut(rng, t.encode(), 9))]
    df = spark.createDataFrame(data, CHUNKS)
    rules = [r for r in ANY_BYTE if "H" not in r] + ["/d.*b/8L"]
    assert rows(stream_scan(df, rules, size=16)) == all_events(rules, texts)
    before, after = df.where("seq < 20"), df.where("seq >= 20")
    rules = [r for r in rules if "\\b" not in r]
    states = carry(before, rules, size=16)
    assert states.select(F.max(F.octet_length("tail"))).first()[0] < 200 * 12, "no run is saved, only where it began"
    got = stream_scan(before, rules).unionByName(stream_scan(resume(after, states), rules, size=16))
    assert rows(got) == all_events(rules, texts)


def test_a_long_stream_is_no_row(spark):
    """Twenty megabytes without a line break: only numbers are gathered by stream."""
    data = spark.range(320).select(
        F.lit(1).cast("bigint").alias("stream_id"), F.col("id").alias("seq"),
        F.when(F.col("id") == 0, "a").otherwise(F.repeat(F.lit("x"), 65_536)).cast("binary").alias("payload"))
    last = spark.createDataFrame([(1, 400, b"b")], CHUNKS)
    assert rows(stream_scan(data.unionByName(last), "/a.*b/sL")) == [(1, 0, 0, 319 * 65_536 + 2)]


def test_what_cannot_be_cut_is_refused(chunks):
    for rule in ("/a.*b.*c/s", "/(é.*b)+c/8L"):
        with pytest.raises(RuleError, match="any byte"):
            stream_scan(chunks, rule)


def test_combinations_of_streams(spark):
    """By epoch, like whole haystacks; while an epoch is open, only what no later byte can change."""
    rules = ["0:/ab+/Q", "1:/c/L", "2:/d.*e/sQ", "10:/0 & 1/C", "11:/!0/C", "12:/2 | !1/C", "13:/(0 | 2) & !1/C", "14:/0/CQ"]
    texts = {1: "xxabbbc", 2: "c d\n e e", 3: "none", 4: "ab", 5: "d ab e"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    data = spark.createDataFrame([(k, i, c.encode()) for k, t in texts.items() for i, c in enumerate(t)], CHUNKS)
    assert rows(stream_scan(data, rules)) == rows(scan(docs, rules))
    assert rows(stream_scan(data, rules, close=False)) == [r for r in rows(scan(docs, rules)) if r[1] in (1, 10)]
    control = data.withColumn("control", F.lit(None).cast("string"))
    control = control.unionByName(spark.createDataFrame([(1, 100, None, "reset"), (1, 101, b"abc", None)], CHUNKS + ", control string"))
    found = rows(stream_scan(control, ["0:/ab+/Q", "1:/c/Q", "10:/0 & 1/C"], epochs=True))
    assert found == [(1, 0, 10, 0, 7), (1, 1, 10, 0, 3)]


def test_handlers_are_a_fold(spark):
    """The batch handler gives what answers joined to events give, and shuffles nothing."""
    texts = ["ab" * k + "c" * (k % 3) for k in range(30)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rules = ["/a/L", "/ab+/", "/c/8L", "/b.*c/L", "9:/0 & !2/C"]

    def handler(events):
        answer = events["to"].map(lambda t: "continue")
        answer[(events["to"] > 9) & (events["pattern_id"] == 0)] = "skip"
        answer[events["to"] > 21] = "terminate"
        return answer

    found = handled_scan(docs, rules, handler)
    action = F.when(F.col("to") > 21, "terminate").when((F.col("to") > 9) & (F.col("pattern_id") == 0), "skip").otherwise("continue")
    assert rows(found) == rows(handle_matches(scan(docs, rules), action))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_horizon(spark):
    df = spark.createDataFrame([(1, 0, 2, 9), (1, 0, 4, 8)], "doc_id long, pattern_id int, `from` long, `to` long")
    assert rows(apply_horizon(df, 5)) == [(1, 0, -1, 9), (1, 0, 4, 8)]


def test_horizon_belongs_to_streams_and_the_whole_set(spark):
    text = b"a" + b"x" * 70_000 + b"b"
    data = spark.createDataFrame([(1, k, text[k * 30_000:(k + 1) * 30_000]) for k in range(3)], CHUNKS)
    rule = lambda i, e, som=None, flags="L": Rule(i, i, e, frozenset(flags), som=som)
    small = rule(0, "a[^\n]*b", "small")
    assert rows(stream_scan(data, [small])) == [(1, 0, -1, 70_002)]
    assert rows(stream_scan(data, [small], horizon=False)) == [(1, 0, 0, 70_002)]
    # a rule that asks for nothing leaves the set as it is, one that asks for more widens it, and ends alone stay 0
    assert rows(stream_scan(data, [small, rule(1, "xb"), rule(2, "a[^\n]*b", None, "")])) == [
        (1, 0, -1, 70_002), (1, 1, 70_000, 70_002), (1, 2, 0, 70_002)]
    assert rows(stream_scan(data, [small, rule(1, "xb", "large", "LQ")])) == [(1, 0, 0, 70_002)]
    control = data.withColumn("control", F.lit(None).cast("string"))
    assert live(spark, control, [small], lambda d: [d]) == [(1, 0, 0, -1, 70_002)]
    # a match within one packet is no boundary match, however long
    whole = spark.createDataFrame([(0, 1, text)], "packet_no long, stream_id long, payload binary")
    assert rows(boundary_matches(whole, [small])) == []


def test_horizon_of_a_large_set_of_texts(spark):
    df = spark.createDataFrame([(1, "a" + "x" * 70_000 + "b")], "doc_id long, text string")
    words = [Rule(i, i, f"word{i}", frozenset("L"), som="large") for i in range(1, 41)]
    small = Rule(0, 0, "a[^\n]*b", frozenset("L"), som="small")
    for n in (20, 40):
        assert rows(scan(df, [small, *words[:n]])) == [(1, 0, 0, 70_002)]
    assert rows(scan(df, [small])) == [(1, 0, 0, 70_002)]


def live(spark, data, rules, files, **options):
    use_rocksdb(spark)
    source, sink = fresh_path(spark, "chunks"), fresh_path(spark, "matches")
    for part in files(data):
        part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1).parquet(source)
    found = live_scan(stream, rules, **options)
    writer = found.writeStream.format("parquet").option("path", sink).option("checkpointLocation", fresh_path(spark, "progress"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return rows(spark.read.parquet(sink).select("stream_id", "epoch", "pattern_id", "from", "to"))


def test_live_equals_batch_out_of_order(spark, chunks, streams):
    closes = chunks.groupBy("stream_id").agg((F.max("seq") + 1).alias("seq")).select(
        "stream_id", "seq", F.lit(None).cast("binary").alias("payload"), F.lit("close").alias("control"))
    data = chunks.withColumn("control", F.lit(None).cast("string")).unionByName(closes)
    # later chunks arrive in an earlier file
    files = lambda d: [d.where("seq % 2 = 1"), d.where("seq % 2 = 0")]
    got = live(spark, data, RULES, files)
    assert [(a, c, d, e) for a, _, c, d, e in got] == expected(streams)


def test_live_single_match_and_reset(spark):
    schema = "stream_id long, seq long, payload binary, control string"
    data = spark.createDataFrame(
        [(1, 0, b"xa", None), (1, 1, b"a test", None), (1, 2, None, "reset"), (1, 3, b"te", None), (1, 4, b"st a", None), (2, 0, b"b", None)],
        schema)
    files = lambda d: [d.where("seq < 2"), d.where("seq >= 2")]
    first = [(1, 0, 0, 1, 2), (1, 0, 1, 4, 8), (1, 1, 0, 5, 6), (1, 1, 1, 0, 4)]
    assert live(spark, data, ["/a/HL", "/test/HL"], files, tasks=3) == first
    # beside others
    assert live(spark, data, ["/a/HL", "/test/HL", "/t/L"], files, tasks=3) == sorted(
        [*first, (1, 0, 2, 4, 5), (1, 0, 2, 7, 8), (1, 1, 2, 0, 1), (1, 1, 2, 3, 4)])
    with pytest.raises(RuleError, match="combinations"):
        live_scan(data, ["/a/L", "9:/0/C"])


def test_closed_streams_leave_no_state(spark):
    schema = "stream_id long, seq long, payload binary, control string"
    data = spark.createDataFrame([(1, 0, b"xa", None), (1, 1, None, "close"), (2, 0, b"a", None)], schema)
    use_rocksdb(spark)
    source, sink, progress = (fresh_path(spark, n) for n in ("chunks", "matches", "progress"))
    data.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(data.schema).parquet(source)
    writer = live_scan(stream, "/a/L").writeStream.format("parquet").option("path", sink).option("checkpointLocation", progress)
    writer.trigger(availableNow=True).start().awaitTermination()
    state = spark.read.format("statestore").option("path", progress).option("stateVarName", "carry").load()
    assert [r.key.stream_id for r in state.select("key").collect()] == [2]


def test_a_stream_opened_again_reports_its_single_match_again(spark):
    schema = "stream_id long, seq long, payload binary, control string"
    life = [(1, 0, b"a tion", None), (1, 1, b" tion", None), (1, 2, None, "close")]
    data = spark.createDataFrame([(n, *r) for n in range(2) for r in life], f"n int, {schema}")
    files = lambda d: [spark.createDataFrame(life, schema), spark.createDataFrame(life, schema)]
    assert live(spark, data.drop("n"), ["/tion/LH", "/n$/LH"], files) == [(1, 0, 0, 2, 6)] * 2 + [(1, 0, 1, 10, 11)] * 2


def test_chunks_put_together_again(spark, streams):
    docs = spark.createDataFrame(list(streams.items()), "doc_id long, text string")
    pieces = chunks_of(docs, size=7)
    assert pieces.where(F.octet_length("payload") > 7).count() == 0
    for r in with_offsets(pieces).collect():
        assert streams[r.stream_id].encode()[r.off:r.off + len(r.data)] == bytes(r.data)


def test_running_sums_over_buckets(spark):
    rng = random.Random(2)
    data = [(k, i, rng.randint(0, 9)) for k in range(3) for i in sorted(rng.sample(range(400), 60))]
    df = spark.createDataFrame(data, "k int, i long, v int")
    out = running_before(df, ["k"], "i", {"s": F.col("v")}, at_last={"m": ("s", F.col("v") == 3)}, bits=3)
    for r in out.collect():
        earlier = [(i, v) for k, i, v in data if k == r.k and i < r.i]
        assert r.s == sum(v for _, v in earlier)
        marks = [sum(v for j, v in earlier if j < i) for i, v in earlier if v == 3]
        assert r.m == (marks[-1] if marks else None)


EVENTS = "doc_id long, pattern_id int, `from` long, `to` long"


def test_limits(spark):
    data = [(1, 0, 0, 3), (1, 1, 1, 3), (1, 0, 2, 5), (2, 1, 0, 1), (2, 1, 0, 4)]
    df = spark.createDataFrame(data, EVENTS)
    assert rows(terminate(df)) == [(1, 0, 0, 3), (2, 1, 0, 1)]
    assert rows(terminate(df, 2)) == [(1, 0, 0, 3), (1, 1, 1, 3), (2, 1, 0, 1), (2, 1, 0, 4)]
    assert rows(skip_rule(df)) == [(1, 0, 0, 3), (1, 1, 1, 3), (2, 1, 0, 1)]
    assert rows(single_match(df)) == rows(skip_rule(df))
    assert rows(within(df, min_offset=3, max_offset=4, min_length=3)) == [(1, 0, 0, 3), (2, 1, 0, 4)]
    stop_at_3 = F.when((F.col("to") == 3) & (F.col("pattern_id") == 0), "terminate").otherwise("continue")
    assert rows(handle_matches(df, stop_at_3)) == [(1, 0, 0, 3), (2, 1, 0, 1), (2, 1, 0, 4)]
    leave_1 = F.when(F.col("pattern_id") == 1, "skip").otherwise("continue")
    assert rows(handle_matches(df, leave_1)) == [(1, 0, 0, 3), (1, 0, 2, 5), (1, 1, 1, 3), (2, 1, 0, 1)]
    assert rows(hits_per_rule(df)) == [(0, 2, 1), (1, 3, 2)]


def test_terminate_keeps_few_rows_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 0, 0, 3)], EVENTS)
    plan = terminate(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_sessions_and_boundaries(spark):
    packets = spark.createDataFrame(
        [(5, "x", b"te"), (7, "y", b"test"), (9, "x", b"st te"), (12, "z", b"s"), (13, "x", b"st")], "packet_no long, who string, payload binary")
    sessions = sessionize(packets, ["who"])
    assert rows(sessions.select("packet_no", "stream_id")) == [(5, 0), (7, 1), (9, 0), (12, 2), (13, 0)]
    assert rows(boundary_matches(sessions, "/test/L")) == [(0, 0, 0, 4), (0, 0, 5, 9)]


def test_sessions_of_sparse_numbers(spark):
    packets = spark.createDataFrame([(10**15 * k, f"w{k % 3}") for k in range(9)], "packet_no long, who string")
    assert rows(session_ids(packets, ["who"]).select("first_no", "stream_id")) == [(0, 0), (10**15, 1), (2 * 10**15, 2)]


def test_boundaries_with_and_without_starts(spark):
    sessions = spark.createDataFrame([(0, 0, b"abcde"), (1, 0, b"click"), (2, 0, b"cli"), (3, 0, b"ck")], "packet_no long, stream_id long, payload binary")
    mixed = ["/click/L", "/li/", "/ec/"]
    assert rows(block_matches(sessions, mixed)) == [(0, 0, 5, 10), (0, 1, 0, 8), (0, 1, 0, 13)]
    assert rows(boundary_matches(sessions, mixed)) == [(0, 0, 10, 15), (0, 2, 0, 6)]
    with pytest.raises(RuleError, match="all report starts"):
        block_matches(sessions, ["1:/a/L", "1:/b/"])


def test_frames(spark):
    fields = "packet_no long, proto int, src long, sport int, dst long, dport int, payload binary"
    sent = spark.createDataFrame(
        [(1, 6, 0x0A000001, 80, 0x0A000002, 1024, b"hello"), (2, 17, 0x0A000001, 53, 0xC0A80001, 9, b"\xff\x00"), (3, 6, 1, 1, 2, 2, b"")], fields)
    frames = encode_frames(sent)
    got = rows(decode_frames(frames))
    assert got == [(1, 6, "10.0.0.1", 80, "10.0.0.2", 1024, b"hello"), (2, 17, "10.0.0.1", 53, "192.168.0.1", 9, b"\xff\x00")]
    first = {r.packet_no: bytes(r.frame) for r in frames.collect()}[1]

    def changed(at, value, extra=b""):
        return first[:at] + bytes([value]) + first[at + 1:] + extra

    bad = [changed(12, 0x86), changed(14, 0x65), changed(20, 0x20), changed(21, 1), changed(23, 1)]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(bad)] + [(9, first + b"\0" * 9)], "packet_no long, frame binary")
    # link padding after the packet is not payload
    assert [(r[0], r[6]) for r in rows(decode_frames(df))] == [(9, b"hello")]


def test_ranking(spark):
    costs = spark.createDataFrame([(i, c) for i, c in enumerate([5, 50, 10, 30, 5])], "pattern_id int, cost long")
    assert rows(rule_ranking(costs, factor=2, generations=9).select("rank", "pattern_id", "generation", "score")) == [
        (1, 1, 0, 20), (2, 3, 0, 20), (3, 2, 1, 5), (4, 0, 1, 5)]


def test_sources(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("é\nb".encode())
    assert [r.text for r in whole_files(spark, str(tmp_path)).collect()] == ["é\nb"]
    raw = whole_files(spark, str(tmp_path), binary=True)
    assert rows(scan(raw, "/b/L", payload="payload", keys=()).select("from", "to")) == [(3, 4)]
    assert rows(stored(spark.range(3), "t")) == [(0,), (1,), (2,)]
