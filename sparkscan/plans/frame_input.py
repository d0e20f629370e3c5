"""Frames made of the given tables, as input of the frame queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.frames import IPV4_ETHERTYPE, TCP, UDP_HEADER


def encode_frames(packets: DataFrame, *, order: str = "packet_no") -> DataFrame:
    """Ethernet frames ``(packet_no, frame)`` for packets with numeric addresses.

    Columns ``proto``, ``src``/``dst`` (IPv4 as BIGINT), ``sport``, ``dport``, ``payload``.
    """

    def be(c: Column, size: int) -> Column:
        return F.unhex(F.lpad(F.hex(c.cast("bigint")), size * 2, "0"))

    tcp = F.col("proto") == TCP
    l4_head = F.when(tcp, F.lit(20)).otherwise(UDP_HEADER)
    n = F.octet_length("payload")
    ports = F.concat(be(F.col("sport"), 2), be(F.col("dport"), 2))
    l4 = F.when(tcp, F.concat(ports, be(F.lit(0), 8), F.unhex(F.lit("5018")), be(F.lit(0), 6))).otherwise(
        F.concat(ports, be(n + UDP_HEADER, 2), be(F.lit(0), 2)))
    frame = F.concat(
        be(F.lit(0), 12), be(F.lit(IPV4_ETHERTYPE), 2),
        F.unhex(F.lit("4500")), be(n + l4_head + 20, 2), be(F.lit(0), 4), F.unhex(F.lit("40")), be(F.col("proto"), 1),
        be(F.lit(0), 2), be(F.col("src"), 4), be(F.col("dst"), 4), l4, F.col("payload"))
    return packets.select(order, frame.alias("frame"))
