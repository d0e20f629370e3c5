"""The audit against a simulation of every order, on awkward rows."""

import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkscan.llm import filter_audit

from .cases import documents, prose, texts

DOCS = "doc_id bigint, text string, lang string, part string, code int, digest string, n string"


def failures(rows):
    """Letters each row fails, by reading the contract."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, t, _ in rows:
        t = t or ""
        words = t.encode().split()
        failed = {"A"} if len(words) < 100 else set()
        failed |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        failed |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t) else set()
        failed |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        failed |= {"E"} if i is not None and i > least[t] else set()
        out.append(failed)
    return out


def simulated(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    failed = failures(rows)
    out = {}
    for part in {p or "" for _, _, p in rows}:
        own = [(i, f) for (i, _, p), f in zip(rows, failed) if (p or "") == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                kept = [x for x in left if letter not in x[1]]
                out[part, "".join(order), step] = [
                    len(kept), len(gone), sum(letter in f for _, f in own) - len(gone), sum(f == {letter} for _, f in own),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), letter]
                shapley[letter] += len(gone)
                left = kept
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return {k: tuple(v) for k, v in out.items()}


def result(df):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in df.collect()}


def cases():
    rows = [(i, t, ("en", None, "", "de")[n % 4]) for n, (i, t) in enumerate(texts())]
    long = " ".join(f"w{k}" for k in range(120))
    rows += [(40, long, "en"), (41, long, "en"), (41, long, "fr"), (41, long, "fr"), (None, long, "en"), (39, long.upper(), "de"),
             (42, long + " $", "en"), (43, None, None), (44, prose(5, 300), "en")]
    labels = [(40, 1, 0), (41, 0, 1), (41, 1, None), (41, 0, 0), (None, 1, 1), (2, None, None), (9, 1, 1), (44, 1, 0), (999, 1, 1)]
    return rows, labels


def test_equals_a_simulation(spark):
    rows, labels = cases()
    df = spark.createDataFrame([(i, t, p, "x", 7, "y", "z") for i, t, p in rows], DOCS)
    known = spark.createDataFrame([(*r, "extra") for r in labels], "doc_id bigint, quality int, toxic int, n string")
    found = filter_audit.filter_audit(df, known)
    assert found.columns == ["part", "filter_order", "step", *filter_audit.FIGURES]
    assert result(found) == simulated(rows, labels)


def test_empty_tables(spark):
    df = documents(spark)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.filter_audit(df.where("false"), labels).count() == 0
    rows = [(i, t, "en") for i, t in texts()]
    assert result(filter_audit.filter_audit(df, labels)) == simulated(rows, [])


def test_other_filters_and_many_parts(spark):
    """Three filters of one's own over more parts than are contracted at a time."""
    rng = np.random.default_rng(3)
    cells = [(f"p{p}", c, int(rng.integers(0, 50)), int(rng.integers(0, 9)), int(rng.integers(0, 9))) for p in range(300) for c in range(8) if rng.random() < 0.7]
    counts = spark.createDataFrame(cells, "part string, code int, n bigint, good bigint, toxic bigint")
    found = result(filter_audit.audit(counts, "xyz"))
    assert len(found) == 300 * 18 - 18 * len({f"p{p}" for p in range(300)} - {c[0] for c in cells})
    by = {}
    for p, c, n, g, t in cells:
        by.setdefault(p, []).append(({"xyz"[k] for k in range(3) if c >> k & 1}, n, g, t))
    for (part, order, step), row in found.items():
        mine, before = order[step - 1], set(order[:step - 1])
        gone = [x for x in by[part] if mine in x[0] and not before & x[0]]
        assert row[0] == sum(n for f, n, *_ in by[part] if not (before | {mine}) & f)
        assert row[1] == sum(x[1] for x in gone) and row[4] == sum(x[2] for x in gone) and row[5] == sum(x[3] for x in gone)


@pytest.mark.parametrize("filters", ["", "AA", "ABCDEFG"])
def test_refused_filters(spark, filters):
    with pytest.raises(ValueError):
        filter_audit.audit(spark.createDataFrame([], "part string, code int, n bigint, good bigint, toxic bigint"), filters)


def test_a_group_of_copies_is_counted_by_key_and_digest(spark):
    """Nothing is joined on the digest alone: a third of the rows may be copies."""
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    labels = spark.createDataFrame([(0, 1, 1), (3, 1, 0)], "doc_id bigint, quality int, toxic int")
    found = result(filter_audit.filter_audit(df, labels))
    assert found["en", "EABCD", 1][:6] == (2001, 999, 0, 0, 1, 0)
