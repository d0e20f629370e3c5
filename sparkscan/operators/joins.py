"""Haystacks joined to rules: by matching, by token, by prefilter."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import spans as S
from ..functions.regex import required_text
from .rule_index import wanted_rules
from .rules import Rule, rule_list
from .scan import RULE_SET


def matching_rules(docs: DataFrame, rules, *, payload: str = "text", keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Pairs ``(keys, pattern_id)`` where the rule matches somewhere in the haystack.

    A few rules are constant patterns of one array expression, compiled once per
    task. Of many, a haystack tries those whose needed text it holds, found in
    one pass; patterns are one constant, so the plan is no larger. Either way a
    haystack is read once for all rules, and only pairs that match are ever made.
    Rules sharing an id give one pair.
    """
    plain = rule_list(rules)
    if len(plain) > RULE_SET:
        found = F.concat(*[
            _matching(S.view_of(F.col(payload), u), group) for u in (False, True) if (group := [r for r in plain if r.utf8 == u])])
        return docs.select(*keys, F.explode(F.array_distinct(found)).alias("pattern_id"))
    views = {u: S.view_of(F.col(payload), u) for u in {r.utf8 for r in plain}}
    seen = docs.select(*keys, *[v.alias(f"__v{int(u)}") for u, v in views.items()])
    tests = [F.when(S.gate(F.col(f"__v{int(r.utf8)}"), r.prepared()), F.lit(r.pattern_id).cast("int")) for r in plain]
    hit = F.array_distinct(F.filter(F.array(*tests), lambda i: i.isNotNull()))
    return seen.select(*keys, F.explode(hit).alias("pattern_id"))


def _matching(view: Column, rules: list[Rule]) -> Column:
    """Ids of the rules that match, given as data: ``array<int>``."""
    prepared = [r.prepared() for r in rules]
    patterns = F.from_json(F.lit(json.dumps([p.exists for p in prepared])), "array<string>")
    ids = F.from_json(F.lit(json.dumps([r.pattern_id for r in rules])), "array<int>")

    def on(text: Column) -> Column:
        hits = F.filter(wanted_rules(text, [p.literal or p.needed for p in prepared]), lambda i: F.rlike(text, F.get(patterns, i)))
        return F.transform(hits, lambda i: F.get(ids, i))

    return S.let(view, lambda text: F.when(text.isNull(), F.array().cast("array<int>")).otherwise(on(text)))


# Words of any script.
TOKEN = r"[\p{L}\p{M}\p{N}_]+"


def _wanted(literals: DataFrame, token: str) -> DataFrame:
    """The dictionary by token; a literal that is not one token could never be found, and is an error."""
    literal = F.col("expression")
    message = F.concat(F.lit("not one token, use phrase_scan: "), literal)
    return literals.select("pattern_id", F.when(literal.rlike(f"^(?:{token})$"), literal).otherwise(F.raise_error(message)).alias("token"))


def token_counts(docs: DataFrame, *, token: str = TOKEN, payload: str = "text") -> DataFrame:
    """``(token, n)`` over all haystacks, reduced map-side."""
    words = docs.select(F.explode(F.regexp_extract_all(F.col(payload), F.lit(token), F.lit(0))).alias("token"))
    return words.groupBy("token").agg(F.count("*").alias("n"))


def dictionary_hits(docs: DataFrame, literals: DataFrame, *, token: str = TOKEN, payload: str = "text") -> DataFrame:
    """Whole-token hits of a literal dictionary of any size: ``(pattern_id, hits)``.

    Tokens are counted before the join and matched with the distinct literals
    first, so both sides hold a token once. Only what is left goes back to the
    rules.
    """
    counted = token_counts(docs, token=token, payload=payload)
    wanted = _wanted(literals, token)
    known = wanted.select("token").distinct().join(counted, "token")
    return wanted.join(known, "token").groupBy("pattern_id").agg(F.sum("n").alias("hits"))


def dictionary_pairs(
    docs: DataFrame, literals: DataFrame, *, token: str = TOKEN, payload: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``(doc_id, pattern_id, hits)`` for a dictionary of any size; a hot token's rows are split by the join."""
    words = docs.select(key, F.explode(F.regexp_extract_all(F.col(payload), F.lit(token), F.lit(0))).alias("token"))
    counted = words.groupBy(key, "token").agg(F.count("*").alias("hits"))
    wanted = _wanted(literals, token).distinct()
    return counted.join(wanted, "token").select(key, "pattern_id", "hits")


def prefilter(rule: Rule | str, payload: Column) -> Column:
    """Cheap test that holds for every haystack the rule matches, and for some others."""
    rule = rule_list(rule)[0]
    needed, caseless = required_text(rule.expression, rule.flags, kind=rule.kind)
    view = S.view_of(payload, rule.utf8)
    if not needed:
        return view.isNotNull()
    return F.lower(view).contains(needed.lower()) if caseless else view.contains(needed)


def confirm(rule: Rule | str, payload: Column) -> Column:
    rule = rule_list(rule)[0]
    return S.gate(S.view_of(payload, rule.utf8), rule.prepared())


def prefilter_candidates(docs: DataFrame, rule: Rule | str, *, payload: str = "text", keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Candidates of a prefilter with the exact answer beside them: ``(keys, confirmed)``."""
    kept = docs.where(prefilter(rule, F.col(payload)))
    return kept.select(*keys, confirm(rule, F.col(payload)).alias("confirmed"))
