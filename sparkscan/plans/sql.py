"""Pieces of checking SQL: spans and end offsets of plain rules, in bytes."""

from __future__ import annotations


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def spans(
    pattern: str, pattern_id: int = 0, *, source: str = "documents", key: str = "doc_id", text: str = "text", som: bool = True
) -> str:
    """Non-overlapping matches of a regex with byte offsets, by adding up gaps and matches."""
    start = '(e - strlen(m))::BIGINT' if som else "0::BIGINT"
    return f"""
      SELECT {key}, {pattern_id}::INT AS pattern_id, {start} AS "from", e::BIGINT AS "to", m AS txt FROM (
        SELECT {key}, m, sum(strlen(gap) + strlen(coalesce(m, ''))) OVER (PARTITION BY {key} ORDER BY i) AS e FROM (
          SELECT {key}, unnest(g) AS gap, unnest(ms) AS m, generate_subscripts(g, 1) AS i FROM (
            SELECT {key}, string_split_regex({text}, {lit(pattern)}) AS g, regexp_extract_all({text}, {lit(pattern)}) AS ms
            FROM {source} WHERE regexp_matches({text}, {lit(pattern)})))) WHERE m IS NOT NULL"""


def literal_ends(literal: str, pattern_id: int = 0, *, source: str = "documents", key: str = "doc_id", text: str = "text", som: bool = True) -> str:
    """Occurrences of a literal that cannot overlap itself."""
    n = len(literal.encode())
    start = f"(e - {n})::BIGINT" if som else "0::BIGINT"
    return f"""
      SELECT {key}, {pattern_id}::INT AS pattern_id, {start} AS "from", e::BIGINT AS "to" FROM (
        SELECT {key}, i, k, sum(strlen(gap) + {n}) OVER (PARTITION BY {key} ORDER BY i) AS e FROM (
          SELECT {key}, unnest(g) AS gap, generate_subscripts(g, 1) AS i, len(g) AS k
          FROM (SELECT {key}, string_split({text}, {lit(literal)}) AS g FROM {source}))) WHERE i < k"""


def grown(pattern: str, pattern_id: int, at_least: int = 1, at_most: int | None = None, som: bool = True, **where) -> str:
    """All ends inside each maximal run: one per length from ``at_least`` on."""
    key = where.get("key", "doc_id")
    start = 's."from"' if at_most is None else f'greatest(s."from", u.e - {at_most})'
    return f"""
      SELECT s.{key}, {pattern_id}::INT AS pattern_id, {start if som else 0}::BIGINT AS "from", u.e::BIGINT AS "to"
      FROM ({spans(pattern, pattern_id, **where)}) s, LATERAL (SELECT unnest(range(s."from" + {at_least}, s."to" + 1)) AS e) u"""


def events(body: str, key: str = "doc_id") -> str:
    return f'SELECT {key}, pattern_id, "from", "to" FROM ({body})'


def union(*parts: str) -> str:
    return " UNION ALL ".join(f"({p})" for p in parts)


def unbounded_events(**where) -> str:
    """Matches of a head, characters of a class and a tail: from the first head of a stretch to every tail after it."""
    key, source, text = where.get("key", "doc_id"), where.get("source", "documents"), where.get("text", "text")

    def after_first(head: str, tail: str, pattern_id: int, som: bool = True) -> str:
        n = len(head.encode())
        return f"""
      SELECT t.{key}, {pattern_id}::INT AS pattern_id, {'h."from"' if som else '0::BIGINT'} AS "from", t."to"
      FROM ({spans(tail, **where)}) t JOIN (SELECT {key}, min("from") AS "from" FROM ({spans(head, **where)}) GROUP BY {key}) h USING ({key})
      WHERE t."from" >= h."from" + {n}"""

    def in_stretch(stretch: str, pattern_id: int, tails: list[str], head: int) -> str:
        ends = " OR ".join(f"e >= s.\"from\" + {head + len(t)} AND b[e - {len(t) - 1}:e] = encode({lit(t)})" for t in tails)
        return f"""
      SELECT s.{key}, {pattern_id}::INT AS pattern_id, s."from", e::BIGINT AS "to"
      FROM ({spans(stretch, **where)}) s JOIN (SELECT {key}, encode({text}) AS b FROM {source}) d USING ({key}),
        LATERAL (SELECT unnest(range(s."from" + 1, s."to" + 1)) AS e) u WHERE {ends}"""

    return union(
        after_first("http", "tion", 0), in_stretch("@[^\n]*", 1, ["."], 1), after_first("é", "è", 2),
        in_stretch("(?:the|and)[a-z ]*", 3, ["ing", "er"], 3), after_first("http", "tion", 4, som=False))


STREAMS = "(SELECT conv_id AS stream_id, string_agg(text, '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id)"

# Texts with every non-ASCII character replaced by as many placeholders as it has bytes.
BYTE_TEXT = (
    "regexp_replace(regexp_replace(regexp_replace(text, '[\\x{80}-\\x{7ff}]', chr(1) || chr(1), 'g'), "
    "'[\\x{800}-\\x{ffff}]', chr(1) || chr(1) || chr(1), 'g'), '[\\x{10000}-\\x{10ffff}]', chr(1) || chr(1) || chr(1) || chr(1), 'g')"
)
