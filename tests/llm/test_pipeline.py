"""The pipeline against plain versions of its stages, and the registered queries against their SQL."""

from collections import Counter

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from sparkscan.llm import quality_model, queries
from sparkscan.llm.common import remainder

from .cases import documents, groups, prose
from .test_packing import checked
from .test_quality_rules import plain

SF_DIR = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where(remainder("doc_id", 4) != 2)
    weights = quality_model.train(docs, labels)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [(i, t) for i, t in rows if plain(t)[-1]]
    rows = [(i, t) for i, t in rows if quality_model.score_of(weights, t) >= 0.7]
    group = groups(rows, 5, 80, 100)
    rows = [(i, t) for i, t in rows if group[i] == i]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in rows}
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    got = Counter()
    for r in out:
        got[r.doc_id] += r.length
    assert got == want
    checked(out, 2048)


@pytest.mark.parametrize("k", range(4))
def test_stage_with_odd_rows(spark, k):
    name, stage = corpus_pipeline.STAGES[k]
    for df in (documents(spark), documents(spark, [])):
        out = stage(spark, df, SF_DIR)
        if k < 3:
            assert out.schema == df.schema, name
        rows = out.collect()
        assert rows == [] or df.count()
        if k == 2 and rows:
            ids = [r.doc_id for r in rows]
            # of equal rows one stays
            assert None in ids and ids.count(9) == 1 and 30 not in ids and {0, 1, 2} <= set(ids)


def test_no_text_is_lost_with_a_copy_of_its_row(spark):
    """One doc_id with a copy of one text and the only example of another; rows without a doc_id."""
    w, q = prose(1, 80), prose(2, 80)
    rows = [(1, w), (5, w), (5, q), (7, q + " z"), (None, prose(3, 80)), (None, prose(3, 80)), (None, w), (8, ""), (8, None), (9, "")]
    out = corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows), SF_DIR)
    assert Counter((r.doc_id, r.text or "") for r in out.collect()) == Counter([(1, w), (5, q), (None, prose(3, 80)), (8, ""), (9, "")])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF_DIR)
    result = con.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}
    assert sorted(names) == sorted(df.columns)
    assert {c: kinds[k] for c, k in df.dtypes} == {d[0]: str(d[1]) for d in result.description}
    want = Counter(tuple(row[names.index(c)] for c in df.columns) for row in result.fetchall())
    assert Counter(map(tuple, df.collect())) == want


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
