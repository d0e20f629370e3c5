import random

import numpy as np
import pytest

from sparkscan.llm import near_dup
from sparkscan.llm.components import components

from .cases import documents, groups, shingles, texts


def corpus():
    """Copies and near copies of several degrees, a star whose rays are not alike, chains, and shared passages."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows, n = [(i, t) for i, t in texts() if i is not None], 100
    shared = [word() for _ in range(60)]
    for size in (8, 40, 150):
        for changes in (1, 2, 4, 8):
            base = [word() for _ in range(size)]
            rows.append((n, " ".join(base)))
            for k in range(12):
                copy = list(base)
                for _ in range(changes):
                    copy[rng.randrange(size)] = word()
                rows.append((n + k + 1, " ".join(copy)))
            n += 13
    for _ in range(40):
        rows.append((n, " ".join([word() for _ in range(rng.randrange(5, 30))] + shared)))
        n += 1
    chain = [word() for _ in range(100)]
    for k in range(25):
        rows.append((n, " ".join(chain)))
        chain = list(chain)
        chain[4 * k] = word()
        n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("words,num", [(3, 85), (5, 80)])
@pytest.mark.parametrize("bucket,block", [(2048, 2_000_000), (3, 400)])
def test_against_all_pairs(spark, monkeypatch, words, num, bucket, block):
    monkeypatch.setattr(near_dup, "MAX_BUCKET", bucket)
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", block)
    rows = corpus()
    out = near_dup.near_duplicates(documents(spark, [*rows, (None, "no key")]), words, num, 100).collect()
    assert out[0].__fields__ == ["doc_id", "n_shingles", "component_id", "kept"]
    want = groups(rows, words, num, 100)
    sets = {i: len(shingles(t, words)) for i, t in rows}
    assert [tuple(r) for r in out if r.doc_id is None] == [(None, max(2 - words + 1, 1), None, False)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out if r.doc_id is not None}
    assert got == {i: (sets[i], c, c == i) for i, c in want.items()}
    assert len(out) == len(rows) + 1


def test_empty_table(spark):
    assert near_dup.near_duplicates(documents(spark, [])).collect() == []
    assert [tuple(r) for r in near_dup.near_duplicates(documents(spark, [(1, None), (2, None)])).collect()] in (
        [(1, 0, 1, True), (2, 0, 2, True)], [(2, 0, 2, True), (1, 0, 1, True)])


def test_signature_distance_is_guaranteed():
    """Any two signatures within r share an index key."""
    rng = np.random.default_rng(1)
    for num in (80, 85, 95):
        r = near_dup.distance_bound(num, 100)
        chunks = near_dup.chunk_places(r)
        assert sorted(p for c in chunks for p in c) == list(range(near_dup.POSITIONS)) and min(map(len, chunks)) > 1
        for _ in range(500):
            wrong = set(rng.choice(near_dup.POSITIONS, r, replace=False).tolist())
            assert any(len(wrong & set(c)) <= 1 for c in chunks)


def test_components(spark):
    rng = random.Random(9)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1200)] + [(2000, 2000 + k) for k in range(1, 300)]
    root = {x: x for e in links for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    want = {x: find(x) for e in links if e[0] != e[1] for x in e}
    got = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert len(got) == len(want) and {r.node: r.component for r in got} == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
