"""Network frames as a table: decode headers with column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import spans as S

# Fixed values from the IPv4, TCP and UDP headers.
ETHERNET_HEADER = 14
IPV4_ETHERTYPE = 0x0800
TCP, UDP = 6, 17
UDP_HEADER = 8


def _u8(view: Column, at: Column | int) -> Column:
    return F.ascii(F.substring(view, at + 1, 1))


def _u16(view: Column, at: Column | int) -> Column:
    return _u8(view, at) * 256 + _u8(view, at + 1)


def _address(view: Column, at: int) -> Column:
    return F.concat_ws(".", *[_u8(view, at + i).cast("string") for i in range(4)])


def decode_frames(frames: DataFrame, *, frame: str = "frame", order: str = "packet_no") -> DataFrame:
    """``(packet_no, proto, src, sport, dst, dport, payload)`` of whole TCP and UDP packets over IPv4.

    Other frames, fragments and empty payloads are left out. A frame is decoded
    once, inside one row expression, and read again only for its payload.
    """
    ip = ETHERNET_HEADER

    def fields(f: Column) -> Column:
        def packet(v: Column) -> Column:
            heads = F.struct(
                v.alias("v"), (_u8(v, ip).bitwiseAND(15) * 4 + ip).alias("l4"), _u8(v, ip + 9).alias("proto"),
                F.least(_u16(v, ip + 2) + ip, F.octet_length(f)).alias("end"))
            return S.let(heads, body)

        def body(h: Column) -> Column:
            v, l4, proto = h["v"], h["l4"], h["proto"]
            tcp = proto == TCP
            start = l4 + F.when(tcp, F.shiftright(_u8(v, l4 + 12), 4) * 4).otherwise(UDP_HEADER)
            stop = F.when(tcp, h["end"]).otherwise(F.least(h["end"], l4 + _u16(v, l4 + 4)))
            whole_packet = (
                (_u16(v, 12) == IPV4_ETHERTYPE) & (F.shiftright(_u8(v, ip), 4) == 4)
                & (_u16(v, ip + 6).bitwiseAND(0x3FFF) == 0) & proto.isin(TCP, UDP))
            return F.struct(
                proto.alias("proto"), _address(v, ip + 12).alias("src"), _u16(v, l4).alias("sport"),
                _address(v, ip + 16).alias("dst"), _u16(v, l4 + 2).alias("dport"),
                F.when(whole_packet, F.substring(f, start + 1, stop - start)).alias("payload"))

        # the largest IPv4 header and a TCP header
        return S.let(F.decode(F.substring(f, F.lit(1), F.lit(ip + 80)), "ISO-8859-1"), packet)

    decoded = F.transform(F.array(F.col(frame)), fields)
    kept = F.filter(decoded, lambda p: F.coalesce(F.octet_length(p["payload"]) > 0, F.lit(False)))
    return frames.select(order, F.inline(kept))
