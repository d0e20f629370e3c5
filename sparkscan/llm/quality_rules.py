"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Every measure of a text is a column; every rule is a row ``(name, ratio, least,
most)`` over those columns. There is no Python on the data path. Repeated 8-word
windows are found by hashing: windows are built by doubling (1, 2, 4, 8 words),
and only texts with a repeated hash are looked at further, by sorting.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES

SYMBOLS = "#*$%&|<>"
# Frequent function words of the four languages, as an indication of running text.
STOP_WORDS = (
    "the of and to in is that for on are with as at by an be was this from or it a "
    "le la les de des et un une est en que qui dans pour du au avec par sur "
    "der die das und ein eine nicht zu den von mit im für auf ist dem "
    "el los las y una por con del se al su para como lo"
).split()
STOP_FORMS = sorted({f for w in STOP_WORDS for f in (w, w.capitalize(), w.upper())})


class Rule(NamedTuple):
    """A text passes if ``least <= ratio <= most``; a bound of ``None`` is open."""

    name: str
    ratio: str
    least: float | None
    most: float | None


# ``%`` would round: the ratios are SQL over the measured columns, with n_words never 0.
RULES = (
    Rule("mean_word_length", "word_chars / n_words", 2.0, 16.0),
    Rule("symbols_per_word", "n_symbols / n_words", None, 0.40),
    Rule("stop_words_per_word", "n_stop_words / n_words", 0.01, None),
    Rule("duplicate_lines", "n_dup_lines / greatest(n_lines, 1)", None, 0.50),
)


def _after(values: Column, k: int) -> Column:
    """The array without its first ``k`` items."""
    return F.slice(values, k + 1, F.greatest(F.size(values) - k, F.lit(0)))


def _pairs(values: Column, k: int) -> Column:
    """Hashes of each item with the one ``k`` places on, where there is one."""
    both = F.zip_with(values, _after(values, k), lambda a, b: F.xxhash64(a, b))
    return F.slice(both, 1, F.greatest(F.size(values) - k, F.lit(0)))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once and kept out of the row format."""
    return F.transform(F.array(value), body)[0]


def _covered(places: Column, width: int) -> Column:
    """How many places lie in ``[p, p + width)`` of some ``p``; places ascend."""
    steps = F.zip_with(places, _after(places, 1), lambda a, b: F.least(F.lit(width), F.coalesce(b - a, F.lit(width))))
    return F.aggregate(steps, F.lit(0), lambda n, x: n + x)


def _repeats(values: Column) -> Column:
    return F.size(F.array_distinct(values)) < F.size(values)


def _repeated_places(windows: Column) -> Column:
    """Ascending places of the hashes that occur more than once."""
    def places(found: Column) -> Column:
        same = F.zip_with(found, _after(found, 1), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
        either = _let(same, lambda s: F.zip_with(s, F.concat(F.array(F.lit(False)), s), lambda a, b: a | b))
        return F.array_sort(F.array_compact(F.zip_with(found, either, lambda f, e: F.when(e, f["i"]))))

    return _let(F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), places)


def _repeat_words(words: Column) -> Column:
    """Words in 8-word windows that occur twice or more."""
    def of_windows(windows: Column) -> Column:
        return F.when(_repeats(windows), _let(_repeated_places(windows), lambda p: _covered(p, 8))).otherwise(0)

    def of_fours(fours: Column) -> Column:
        return F.when(_repeats(fours), _let(_pairs(fours, 4), of_windows)).otherwise(0)

    return _let(_pairs(words, 1), lambda twos: _let(_pairs(twos, 2), of_fours)).cast("bigint")


def measures(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Add the measures of ``text`` as columns named ``prefix`` + measure, in place of any of these names.

    A null text has no words. A line counts if it holds a word.
    """
    p = prefix
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words, lines = f"__{p}words", f"__{p}lines"
    df = df.withColumns({
        words: F.array_remove(F.split(body, SPACES), ""),
        lines: F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        f"{p}n_symbols": F.regexp_count(body, F.lit(f"[{SYMBOLS}]")).cast("bigint"),
    })
    return df.withColumns({
        f"{p}n_words": F.size(words).cast("bigint"),
        f"{p}word_chars": F.length(F.array_join(words, "")).cast("bigint"),
        f"{p}n_lines": F.size(lines).cast("bigint"),
        f"{p}n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
        f"{p}n_stop_words": F.size(F.filter(F.col(words), lambda x: x.isin(STOP_FORMS))).cast("bigint"),
        f"{p}n_repeat_words": _repeat_words(F.col(words)),
    }).drop(words, lines)


def judged(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", prefix: str = "") -> DataFrame:
    """``measures`` with ``base_failed``, ``failed_rules`` (names) and ``kept``.

    A text fails the base with under 20 words, or if over 30 % of its words lie
    in repeated 8-word windows. Ratios are tested as they are, ends included.
    Repeated rows are judged alike, and an empty table stays empty.
    """
    p = prefix
    df = measures(df, text, prefix)
    n_words = F.col(f"`{p}n_words`")
    base = (n_words < 20) | (100 * F.col(f"`{p}n_repeat_words`") > 30 * n_words)
    failed = []
    for rule in rules:
        ratio = rule.ratio
        for name in ("word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines", "n_stop_words"):
            ratio = ratio.replace(name, f"`{p}{name}`") if p else ratio
        value = F.when(n_words > 0, F.expr(ratio))
        out = F.lit(False)
        if rule.least is not None:
            out = out | (value < rule.least)
        if rule.most is not None:
            out = out | (value > rule.most)
        failed.append(F.when(out, F.lit(rule.name)))
    df = df.withColumns({f"{p}base_failed": base, f"{p}failed_rules": F.array_compact(F.array(*failed))})
    return df.withColumn(f"{p}kept", ~F.col(f"`{p}base_failed`") & (F.size(f"`{p}failed_rules`") == 0))


def quality_rules(df: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Judge every text: ``(key, n_words, word_chars, ..., base_failed, failed_rules, kept)``, one row per row.

    A null text has no words and fails; repeated rows give repeated results, an empty table none.
    """
    return judged(df.select(F.col(key), F.col(text)), rules, text).drop(text)


def passing(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows whose text is kept, with the columns of ``df``. Names of the measures don't clash with columns."""
    prefix = "__rule_"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    columns = [f"`{c}`" for c in df.columns]
    # a filter would be pushed below the projection and compute every measure again for every rule
    once = F.when(F.col(f"`{prefix}kept`"), F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    return judged(df, rules, text, prefix).select(*columns, F.explode(once).alias(f"{prefix}one")).select(*columns)
