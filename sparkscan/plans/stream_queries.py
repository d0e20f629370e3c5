"""Streams: conversations in turns, packets of sessions, live queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sessions import boundary_matches, session_scan_stats, sessionize
from ..session import fresh_path, stored
from ..sources.documents import read_table
from ..sources.frames import decode_frames
from ..streaming.batch import carry, fork, resume, rewind, stream_scan
from ..streaming.live import ROCKSDB, live_scan
from .frame_input import encode_frames
from .registry import conversations, query
from .scan_queries import UNBOUNDED
from .sql import STREAMS, spans, unbounded_events, union

RULES = ["/tion/L", "/e+r/L", r"/[a-z]\.\n[A-Z]/L"]


def stream_events(body: str) -> str:
    return f'SELECT stream_id, pattern_id, "from", "to" FROM ({body})'


def rule_events(source: str = STREAMS, key: str = "stream_id") -> str:
    return union(*[
        f'SELECT {key}, pattern_id, "from", "to" FROM ({spans(p, i, source=source, key=key)})'
        for i, p in enumerate(("tion", "e+r", r"[a-z]\.\n[A-Z]"))
    ])


@query(rule_events())
def stream_scan_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_scan(conversations(spark, sf_dir), RULES)


@query(unbounded_events(source=STREAMS, key="stream_id"))
def stream_unbounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches of any length over whole conversations, across lines and in UTF-8."""
    return stream_scan(conversations(spark, sf_dir), UNBOUNDED)


@query(union(stream_events(spans(r"[.]\z", 0, source=STREAMS, key="stream_id")), stream_events(spans(r"tion\b", 1, source=STREAMS, key="stream_id"))))
def stream_close_eod(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_scan(conversations(spark, sf_dir), ["/[.]$/L", r"/tion\b/L"])


@query(f"""SELECT * FROM ({rule_events()}) QUALIFY row_number() OVER (PARTITION BY stream_id, pattern_id ORDER BY "to") = 1""")
def stream_singlematch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_scan(conversations(spark, sf_dir), ["/tion/LH", "/e+r/LH", r"/[a-z]\.\n[A-Z]/LH"])


EPOCHS = """(SELECT conv_id * 1000 + turn // 3 AS stream_id, string_agg(text, '' ORDER BY turn) AS text
  FROM conversations GROUP BY conv_id, turn // 3)"""


@query(f"""SELECT (stream_id // 1000)::BIGINT AS stream_id, (stream_id % 1000)::BIGINT AS epoch, pattern_id, "from", "to" FROM ({rule_events(EPOCHS)})""")
def stream_reset_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversations(spark, sf_dir)
    chunks = turns.select("stream_id", (F.col("seq") * 2).alias("seq"), "payload", F.lit(None).cast("string").alias("control"))
    resets = turns.where((F.col("seq") > 0) & (F.col("seq") % 3 == 0)).select(
        "stream_id", (F.col("seq") * 2 - 1).alias("seq"), F.lit(None).cast("string").alias("payload"), F.lit("reset").alias("control"))
    return stream_scan(chunks.unionByName(resets), RULES, epochs=True)


FORK_AT = "(SELECT conv_id, sum(strlen(text)) AS off FROM conversations WHERE turn < 2 GROUP BY conv_id)"


@query(f"""
WITH m AS ({rule_events()})
SELECT * FROM m UNION ALL
SELECT m.stream_id + 1000000, m.pattern_id, m."from", m."to" FROM m JOIN {FORK_AT} f ON m.stream_id = f.conv_id WHERE m."to" > f.off""")
def stream_fork(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversations(spark, sf_dir)
    states = carry(turns.where("seq < 2"), RULES)
    children = states.select((F.col("stream_id") + 1_000_000).alias("stream_id"), F.col("stream_id").alias("parent_id"))
    own = turns.where("seq >= 2").withColumn("stream_id", F.col("stream_id") + 1_000_000)
    forked = stream_scan(fork(own, states, children), RULES)
    return stream_scan(turns, RULES).unionByName(forked)


@query(rule_events())
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversations(spark, sf_dir)
    # the saved state is a table in shared storage, as it would be between two jobs
    states = carry(turns.where("seq < 3"), RULES)
    before = stream_scan(turns.where("seq < 3"), RULES, close=False)
    return before.unionByName(stream_scan(resume(turns.where("seq >= 3"), states), RULES))


BEFORE = "(SELECT conv_id AS stream_id, string_agg(text, '' ORDER BY turn) AS text FROM conversations WHERE turn < 2 GROUP BY conv_id)"


@query(f"""
WITH m AS ({rule_events()})
SELECT * FROM m
UNION ALL SELECT m.* FROM m JOIN {FORK_AT} f ON m.stream_id = f.conv_id WHERE m."to" > f.off""")
def stream_rewind_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole streams; then back to the state saved after two turns, and all later turns again."""
    turns = conversations(spark, sf_dir)
    states = carry(turns.where("seq < 2"), RULES)
    ends = turns.groupBy("stream_id").agg((F.max("seq") + 1).alias("at")).where("at > 2")
    saved = stored(states.join(ends, "stream_id"), "saved")
    later = turns.where("seq >= 2").join(saved.select("stream_id", "at"), "stream_id")
    again = later.select("stream_id", (F.col("seq") + F.col("at")).alias("seq"), "payload")
    return stream_scan(rewind(turns.unionByName(again), saved, F.col("at")), RULES)


@query(f"""
WITH m AS ({rule_events()}), own AS ({rule_events(BEFORE)})
SELECT * FROM m UNION ALL
SELECT stream_id + 1000000, pattern_id, "from", "to" FROM own UNION ALL
SELECT m.stream_id + 1000000, m.pattern_id, m."from", m."to" FROM m JOIN {FORK_AT} f ON m.stream_id = f.conv_id WHERE m."to" > f.off""")
def stream_reset_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams that have read two turns are reset and become copies of others, then go on with the others' later turns."""
    turns = conversations(spark, sf_dir)
    states = carry(turns.where("seq < 2"), RULES)
    other = turns.withColumn("stream_id", F.col("stream_id") + 1_000_000)
    copies = states.withColumn("stream_id", F.col("stream_id") + 1_000_000)
    return stream_scan(turns, RULES).unionByName(stream_scan(rewind(other, copies, F.lit(2)), RULES))


@query(union(
    stream_events(spans("tion", 0, source=STREAMS, key="stream_id")),
    stream_events(spans(r"[a-z]\.\n[A-Z]", 1, source=STREAMS, key="stream_id")),
    stream_events(spans(r"[.]\z", 2, source=STREAMS, key="stream_id"))))
def stream_scan_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as files, read as a stream, scanned with keyed state, and read back."""
    turns = conversations(spark, sf_dir)
    control = F.lit(None).cast("string")
    chunks = turns.select("stream_id", "seq", "payload", control.alias("control"))
    closes = turns.groupBy("stream_id").agg((F.max("seq") + 1).alias("seq")).select(
        "stream_id", "seq", control.alias("payload"), F.lit("close").alias("control"))
    return live_events(chunks.unionByName(closes), ["/tion/L", r"/[a-z]\.\n[A-Z]/L", "/[.]$/L"])


def live_events(chunks: DataFrame, rules: list[str], **options) -> DataFrame:
    """Chunks written as files, read as a stream, scanned until all are read; the matches read back."""
    spark = chunks.sparkSession
    source, sink = fresh_path(spark, "chunks"), fresh_path(spark, "matches")
    chunks.repartition(2).write.parquet(source)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        stream = spark.readStream.schema(chunks.schema).option("maxFilesPerTrigger", 1).parquet(source)
        found = live_scan(stream, rules, **options).drop("epoch")
        writer = found.writeStream.format("parquet").option("path", sink).option("checkpointLocation", fresh_path(spark, "progress"))
        writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(found.schema).parquet(sink)


@query(rule_events())
def stream_resume_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three turns of each conversation scanned as a table and their state saved; the later ones as a live stream that begins with it."""
    turns = conversations(spark, sf_dir)
    first = turns.where("seq < 3")
    states = carry(first, RULES, cut=False)
    later = turns.where("seq >= 3").select(
        "stream_id", (F.col("seq") - 3).alias("seq"), "payload", F.lit(None).cast("string").alias("control"))
    return stream_scan(first, RULES, close=False).unionByName(live_events(later, RULES, states=states))


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as packets: a session per user and event type."""
    rows = read_table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "props")
    return rows.select(
        F.col("event_id").alias("packet_no"), "user_id", "event_type",
        F.concat("event_type", "props").cast("binary").alias("payload"))


KEY = ("user_id", "event_type")


def session_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets with their session, written once: several scans read them."""
    return stored(sessionize(packets(spark, sf_dir), KEY).select("packet_no", "stream_id", "payload"), "packets")


SESSIONS = """(SELECT *, (dense_rank() OVER (ORDER BY first_no) - 1)::BIGINT AS stream_id FROM (
  SELECT event_id, event_type || props AS payload, min(event_id) OVER (PARTITION BY user_id, event_type) AS first_no FROM events))"""


@query(f"SELECT event_id AS packet_no, stream_id, first_no FROM {SESSIONS}", name="sessionize")
def sessionize_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessionize(packets(spark, sf_dir), KEY).select("packet_no", "stream_id", "first_no")


SESSION_TEXTS = f"(SELECT stream_id, string_agg(payload, '' ORDER BY event_id) AS text FROM {SESSIONS} GROUP BY stream_id)"
PACKET_TEXTS = f"(SELECT event_id AS stream_id, payload AS text FROM {SESSIONS})"
PACKET_RULES = ["/click/L", r"/\}(view|click)/L", r"/[0-9]\}e/L"]
PACKET_PATTERNS = ["click", r"\}(?:view|click)", r"[0-9]\}e"]


def _packet_events(source: str) -> str:
    return union(*[
        f'SELECT stream_id, pattern_id, "from", "to" FROM ({spans(p, i, source=source, key="stream_id")})'
        for i, p in enumerate(PACKET_PATTERNS)
    ])


@query(f"""
WITH p AS (SELECT * FROM {SESSIONS}),
 t AS (SELECT count(*) AS packets, count(DISTINCT stream_id) AS streams, sum(strlen(payload))::BIGINT AS bytes FROM p),
 s AS (SELECT count(*) AS n FROM ({_packet_events(SESSION_TEXTS)})), b AS (SELECT count(*) AS n FROM ({_packet_events(PACKET_TEXTS)}))
SELECT packets, streams, bytes, bytes // packets AS avg_packet, bytes // streams AS avg_stream,
  s.n * 2 AS stream_matches, b.n * 2 AS block_matches,
  (s.n * 2) / (bytes * 2 / 1024) AS stream_rate, (b.n * 2) / (bytes * 2 / 1024) AS block_rate
FROM t, s, b""", name="session_scan_stats")
def session_stats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_scan_stats(session_packets(spark, sf_dir), PACKET_RULES, repeats=2)


@query(f"""
WITH p AS (SELECT stream_id, event_id, payload AS text,
    sum(strlen(payload)) OVER (PARTITION BY stream_id ORDER BY event_id) - strlen(payload) AS off FROM {SESSIONS}),
 b AS ({_packet_events(PACKET_TEXTS)})
SELECT * FROM ({_packet_events(SESSION_TEXTS)})
EXCEPT SELECT p.stream_id, b.pattern_id, (b."from" + p.off)::BIGINT, (b."to" + p.off)::BIGINT FROM b JOIN p ON b.stream_id = p.event_id""",
       name="boundary_matches")
def boundary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boundary_matches(session_packets(spark, sf_dir), PACKET_RULES)


@query("""
SELECT event_id AS packet_no, (CASE WHEN event_id % 2 = 0 THEN 6 ELSE 17 END)::INT AS proto,
  '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS src, (1024 + user_id % 1000)::INT AS sport,
  '192.168.0.' || strlen(event_type) AS dst, (80 + strlen(props))::INT AS dport, props AS payload
FROM events WHERE event_type <> 'view'""")
def frames_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "props")
    sent = rows.select(
        F.col("event_id").alias("packet_no"),
        F.when(F.col("event_id") % 2 == 0, 6).otherwise(17).alias("proto"),
        (F.lit(10 << 24) + F.col("user_id")).alias("src"), (1024 + F.col("user_id") % 1000).alias("sport"),
        (F.lit((192 << 24) + (168 << 16)) + F.length("event_type")).alias("dst"), (80 + F.length("props")).alias("dport"),
        # frames without payload are dropped by the decoder
        F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("props")).cast("binary").alias("payload"))
    return decode_frames(encode_frames(sent)).withColumn("payload", F.col("payload").cast("string"))


@query("""
SELECT event_id AS packet_no, 6::INT AS proto, '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS src, 80::INT AS sport,
  '192.168.0.1' AS dst, 81::INT AS dport, CASE WHEN event_id % 8 = 7 THEN substr(props, 5) ELSE props END AS payload
FROM events WHERE event_id % 8 IN (6, 7)""")
def frames_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of every kind that is left out, beside two that are kept, one of them with TCP options."""
    rows = read_table(spark, sf_dir, "events", "event_id", "user_id", "props")
    frames = encode_frames(rows.select(
        F.col("event_id").alias("packet_no"), F.lit(6).alias("proto"), (F.lit(10 << 24) + F.col("user_id")).alias("src"),
        F.lit(80).alias("sport"), F.lit((192 << 24) + (168 << 16) + 1).alias("dst"), F.lit(81).alias("dport"),
        F.col("props").cast("binary").alias("payload")))

    def put(at: int, value: int):
        return F.overlay("frame", F.lit(bytes([value])), F.lit(at + 1))

    # other protocol above the link, other version, more fragments, later fragment, other transport, no payload
    changed = [put(12, 0x86), put(14, 0x65), put(20, 0x20), put(21, 1), put(23, 1), F.substring("frame", 1, 54)]
    # four bytes of options before the payload
    changed += [F.col("frame"), put(46, 0x60)]
    kind = F.col("packet_no") % 8
    frame = F.coalesce(*[F.when(kind == k, c) for k, c in enumerate(changed)])
    return decode_frames(frames.withColumn("frame", frame)).withColumn("payload", F.col("payload").cast("string"))
