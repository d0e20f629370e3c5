from collections import Counter

from sparkscan.llm import quality_rules
from sparkscan.llm.quality_rules import STOP_FORMS, Rule

from .cases import documents, prose, texts

JUNK = "Rewh.### And&&& a$$$ thouhe$$$ and&&& ththonble*** thndingst*** of%%% en%%% erhe.### " * 3


def plain(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    repeat = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    n, chars, marks = len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text)
    dup = len(lines) - len(set(lines))
    base = n < 20 or 100 * len(repeat) > 30 * n
    kept = not base and 2 <= chars / n <= 16 and marks / n <= 0.4 and sum(w in STOP_FORMS for w in words) / n >= 0.01 and dup / max(len(lines), 1) <= 0.5
    return n, chars, marks, dup, len(repeat), base, kept


def rows():
    half = prose(1, 30)
    return texts() + [(40, JUNK), (41, f"{half} {prose(2, 50)} {half}"), (42, "a b c d e f g h " * 30), (43, "x y " * 9 + "x"),
                      (44, "line of the text\n" * 30), (45, "\u00a0\u2003of the " * 15), (46, prose(5, 4000) + prose(5, 900)), (47, "the a " + "b" * 400 + " c" * 30)]


def test_against_plain_counts(spark):
    out = quality_rules.quality_rules(documents(spark, rows()))
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in out.collect())
    assert got == sorted((str(i), *plain(t)) for i, t in rows())
    assert "Python" not in out._jdf.queryExecution().toString()


def test_passing_keeps_the_columns(spark):
    df = documents(spark, rows())
    out = quality_rules.passing(df)
    assert out.schema == df.schema
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(i) for i, t in rows() if plain(t)[-1])
    odd = df.withColumnRenamed("words", "__rule_words")
    assert quality_rules.passing(odd).columns == odd.columns and quality_rules.passing(odd).count() == out.count()
    assert quality_rules.passing(documents(spark, [])).collect() == []


def test_rules_are_a_table(spark):
    some = (Rule("long", "n_words", 100, None), Rule("marks", "n_symbols / n_words", None, 0.1))
    out = {r.doc_id: r for r in quality_rules.quality_rules(documents(spark, [(1, prose(1, 50).replace("#", "")), (2, JUNK)]), some).collect()}
    assert "long" in out[1].failed_rules and set(out[2].failed_rules) == {"long", "marks"}
