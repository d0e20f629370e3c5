"""Packets to sessions, session scans and their statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..streaming.batch import stream_scan, with_offsets
from ..functions.regex import RuleError
from .numbering import running_before
from .rules import horizon_bytes, rule_list
from .scan import apply_horizon, scan

SESSION_KEY = ("proto", "src", "sport", "dst", "dport")


def session_ids(packets: DataFrame, key: Sequence[str] = SESSION_KEY, order: str = "packet_no") -> DataFrame:
    """One row per session: its key, first packet, and id in order of first appearance (from 0).

    First packets come from a map-side minimum; the numbering is a bucketed
    running count, so neither a hot session nor the number of sessions reaches
    one task.
    """
    firsts = packets.groupBy(*key).agg(F.min(F.col(order).cast("bigint")).alias("first_no"))
    return running_before(firsts, [], "first_no", {"stream_id": F.lit(1)})


def sessionize(packets: DataFrame, key: Sequence[str] = SESSION_KEY, order: str = "packet_no") -> DataFrame:
    """Packets with their ``stream_id`` (and the session's ``first_no``)."""
    return packets.join(session_ids(packets, key, order), list(key))


def as_chunks(packets: DataFrame, order: str = "packet_no") -> DataFrame:
    return packets.select("stream_id", F.col(order).cast("bigint").alias("seq"), "payload")


def block_matches(packets: DataFrame, rules, order: str = "packet_no") -> DataFrame:
    """Every packet scanned on its own, offsets shifted to its place in the session."""
    placed = with_offsets(as_chunks(packets, order))
    found = scan(placed, rules, payload="data", keys=("stream_id", "seq", "off"))
    # a rule that does not report starts keeps from = 0
    start = F.when(F.col("pattern_id").isin(*ids_with_starts(rules)), F.col("from") + F.col("off")).otherwise(F.lit(0))
    return found.select("stream_id", "pattern_id", start.cast("bigint").alias("from"), (F.col("to") + F.col("off")).alias("to"))


def ids_with_starts(rules) -> list[int]:
    """Ids whose events have start offsets; rules of one id must agree on that."""
    plain = rule_list(rules)
    starts = {r.pattern_id for r in plain if "L" in r.flags}
    for r in plain:
        if "L" not in r.flags and r.pattern_id in starts:
            raise RuleError("rules of one id must all report starts, or none", r.ord)
    return sorted(starts)


def boundary_matches(packets: DataFrame, rules, order: str = "packet_no") -> DataFrame:
    """Matches only the stream scan finds: those that span packets. Rules must have no anchors.

    Of a rule without start offsets, these are the ends at which no match lies within one packet.
    """
    streamed = stream_scan(as_chunks(packets, order), rules, horizon=False)
    found = streamed.join(block_matches(packets, rules, order), ["stream_id", "pattern_id", "from", "to"], "left_anti")
    return apply_horizon(found, horizon_bytes(rule_list(rules)), ids_with_starts(rules))


def session_scan_stats(packets: DataFrame, rules, order: str = "packet_no", repeats: int = 1) -> DataFrame:
    """One row: sizes, averages (integer division, zero guarded) and match rates per kilobyte of both modes."""
    sizes = packets.agg(
        F.count("*").alias("packets"),
        F.count_distinct("stream_id").alias("streams"),
        F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).cast("bigint").alias("bytes"),
    )
    streamed = stream_scan(as_chunks(packets, order), rules).agg(F.count("*").alias("n"))
    blocked = scan(packets, rules, payload="payload", keys=(order,)).agg(F.count("*").alias("n"))
    out = sizes.select("*", (streamed.scalar() * repeats).alias("stream_matches"), (blocked.scalar() * repeats).alias("block_matches"))
    kilobytes = F.col("bytes") * repeats / 1024
    return out.select(
        "packets", "streams", "bytes",
        F.floor(F.col("bytes") / F.greatest("packets", F.lit(1))).cast("bigint").alias("avg_packet"),
        F.floor(F.col("bytes") / F.greatest("streams", F.lit(1))).cast("bigint").alias("avg_stream"),
        "stream_matches", "block_matches",
        (F.col("stream_matches") / F.nullif(kilobytes, F.lit(0.0))).alias("stream_rate"),
        (F.col("block_matches") / F.nullif(kilobytes, F.lit(0.0))).alias("block_rate"),
    )
