"""Texts without repeated windows against all windows compared."""

import hashlib
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from sparkscan.llm import substring_dedup as sd

from .cases import documents, prose, texts


def plain(rows, width):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (key, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone |= set(range(i, i + width))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((key, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def found(df, width):
    return Counter(tuple(r) for r in sd.without_repeats(df, width).collect())


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, key string, at int")


def test_awkward_rows(spark):
    rows = texts()
    assert found(documents(spark, rows), 35) == plain(rows, 35)
    assert found(documents(spark).where("false"), 35) == Counter()


def test_passages_of_all_lengths_around_the_window(spark):
    """Spans of 30 to 60 shared words at the start, the middle and the end, next to branches and tips."""
    rng = random.Random(5)
    word = lambda: "w%d" % rng.randrange(10**6)
    own = lambda n: [word() for _ in range(n)]
    rows, key = [], 0
    base = own(400)
    for n in range(30, 61):
        at = rng.randrange(0, 400 - n)
        for before, after in ((0, 20), (20, 0), (rng.randrange(40), rng.randrange(40))):
            rows.append((key, " ".join(own(before) + base[at:at + n] + own(after))))
            key += 1
    twice = own(45)
    rows += [(key, " ".join(own(10) + twice + own(9) + twice)), (key + 1, "\t".join(base)), (key + 2, " ".join(base[200:] + base[:200]))]
    rows += [(key + 3, "same " * 300), (key + 4, "a b " * 40), (key + 5, " ".join(own(34))), (key + 5, " ".join(own(35)))]
    assert found(table(spark, rows), 35) == plain(rows, 35)


def test_random_texts_over_few_words(spark):
    """Many branches, short periods, windows that overlap themselves."""
    rng = random.Random(11)
    for width, letters in ((16, 2), (17, 3), (20, 2)):
        rows = [(i, " ".join(rng.choice("abcd"[:letters]) for _ in range(rng.randrange(0, 120)))) for i in range(60)]
        rows += [(100 + i, rows[i][1]) for i in range(5)] + [(None, rows[7][1]), (3, rows[3][1])]
        assert found(table(spark, rows), width) == plain(rows, width)


def test_every_window_holds_a_sampled_gram_of_its_own():
    """Equal windows are found under the same seed, at the same place, whatever stands around them."""
    rng = np.random.default_rng(2)
    inner = rng.integers(0, 5, 60, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    seeds = []
    for _ in range(20):
        h = np.concatenate([rng.integers(0, 1 << 63, rng.integers(0, 50), np.uint64), inner, rng.integers(0, 1 << 63, rng.integers(0, 50), np.uint64)])
        starts, counts, found = sd.sampled(h, 35)
        assert counts.sum() == len(h) - 34 and (counts > 0).all()
        where = next(i for i in range(len(h)) if (h[i:i + 60] == inner).all())
        by_window = np.repeat(found, counts)
        seeds.append(by_window[where:where + 26].tolist())
    assert all(s == seeds[0] for s in seeds)


def test_paths_are_fewer_than_pieces_and_name_their_sources(spark):
    text = prose(1, 2000)
    rows = [(1, text), (2, "Before it " + text), (3, text + " after it"), (4, prose(2, 500))]
    places = sd.repeated_pieces(table(spark, rows), 35, "doc_id", "text")
    paths = sd.repeated_paths(places)
    assert paths.agg(F.sum("n")).first()[0] == places.agg(F.sum("n")).first()[0]
    assert paths.count() < places.count() / 5
    assert paths.groupBy("seed", "digest").count().where("count = 3").count() >= 1


def test_a_passage_in_very_many_texts(spark):
    """A hot seed branches once at each end of every text; windows grow with the texts, not with their pairs."""
    rng = random.Random(3)
    passage = ["p%d" % i for i in range(50)]
    rows = [(i, " ".join(["x%d" % rng.randrange(10**9) for _ in range(20)] + passage + ["y%d" % rng.randrange(10**9) for _ in range(20)])) for i in range(800)]
    got = sd.without_repeats(table(spark, rows), kept_text=True).collect()
    assert all(r.n_words == 90 and r.n_removed == 50 and "p0" not in r.kept.split() and len(r.kept.split()) == 40 for r in got)
