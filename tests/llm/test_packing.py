import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparkscan.llm import packing

from .cases import documents, texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def one_by_one(lengths, capacity):
    """The same method, one sequence after another."""
    left, out = sorted(lengths), []

    def best(gap):
        some = [x for x in left if x <= gap]
        return some[-1] if some else 0

    while left:
        held = [left.pop()]
        gap = capacity - held[0]
        while gap and (x := best(gap)):
            left.remove(x)
            held.append(x)
            gap -= x
        while gap and len(held) > 1:
            room = gap + held[-1]
            some = [x for x in left if x < room]
            two = max(((a + b, -a) for i, a in enumerate(some) for b in some[:i] if a + b <= room), default=(0, 0))
            if two[0] <= held[-1]:
                break
            a, b = -two[1], two[0] + two[1]
            left.remove(a)
            left.remove(b)
            left.append(held.pop())
            left.sort()
            held = sorted([*held, a, b], reverse=True)
            gap = room - a - b
        out.append(tuple(held))
    return Counter(out)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_that_of_one_sequence_after_another(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, [30, 50, 12, 64, 40, 20][seed], 150).tolist()
    fill, got = packing.Fill(Counter(lengths), 64), Counter()
    while fill.left.any():
        held, many = fill.sequence()
        got[tuple(held)] += many
    assert got == one_by_one(lengths, 64)


def checked(out, capacity):
    at = {}
    for r in out:
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in at.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= capacity
    return len(at)


@pytest.mark.parametrize("bucket", [4000, 2])
def test_pieces_and_places(spark, monkeypatch, bucket):
    monkeypatch.setattr(packing, "BUCKET_ROWS", bucket)
    library = Tokenizer.from_file(PATH)
    out = packing.pack(documents(spark), PATH, 64).collect()
    assert out[0].__fields__ == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    want = []
    for i, t in texts():
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % 64 + 1
        for p, start in enumerate([0, *range(first, len(ids), 64)]):
            part = ids[start:first if p == 0 else start + 64]
            want.append((str(i), p, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((str(r[0]), *r[1:5]) for r in out) == sorted(want)
    assert checked(out, 64) <= 1.03 * sum(r.length for r in out) / 64 + 1


def test_table(spark):
    out = packing.pack(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), PATH).collect()
    assert checked(out, 2048) <= 1.02 * sum(r.length for r in out) / 2048 + 1
    assert packing.pack(documents(spark, []), PATH).collect() == []
