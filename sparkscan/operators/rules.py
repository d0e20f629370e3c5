"""The rule table: schema, inputs, validation and set operations."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.regex import Prepared, RuleError, prepare

# Flag letters in the order they are written, and constraint names.
FLAGS = {"regex": "imsHV8WPLCQ", "literal": "imHL", "pcre": "imsH8W"}
EXT_KEYS = ("min_offset", "max_offset", "min_length", "edit_distance", "hamming_distance")
# Start-offset horizons in bytes.
SOM_HORIZONS = {"large": None, "medium": 2**32, "small": 2**16}

EXT_TYPE = T.StructType(
    [
        T.StructField("min_offset", T.LongType()),
        T.StructField("max_offset", T.LongType()),
        T.StructField("min_length", T.LongType()),
        T.StructField("edit_distance", T.IntegerType()),
        T.StructField("hamming_distance", T.IntegerType()),
    ]
)
RULES_SCHEMA = T.StructType(
    [
        T.StructField("ord", T.IntegerType()),
        T.StructField("pattern_id", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("expression", T.StringType()),
        T.StructField("flags", T.ArrayType(T.StringType())),
        T.StructField("ext", EXT_TYPE),
        T.StructField("som", T.StringType()),
    ]
)
# Rules are prepared on the driver, so their number is checked; larger sets of plain texts are joined, without a limit.
MAX_RULES = 100_000


@dataclass(frozen=True)
class Rule:
    ord: int
    pattern_id: int
    expression: str
    flags: frozenset[str] = frozenset()
    kind: str = "regex"
    ext: dict = field(default_factory=dict, hash=False)
    som: str | None = None

    def prepared(self) -> Prepared:
        try:
            return prepare(self.expression, self.flags, kind=self.kind)
        except RuleError as e:
            raise RuleError(str(e), self.ord) from e

    @property
    def utf8(self) -> bool:
        return "8" in self.flags

    def row(self) -> tuple:
        flags = [f for f in FLAGS["regex"] if f in self.flags]
        ext = tuple(self.ext.get(k) for k in EXT_KEYS)
        return (self.ord, self.pattern_id, self.kind, self.expression, flags, ext, self.som)


def parse_line(line: str, ord: int = 0, kind: str = "regex") -> Rule:
    """``[id:]/expression/flags{constraints}``, or a bare expression."""
    line = line.strip()
    numbered = re.match(r"(\d+):(?=/)", line)
    body = line[numbered.end():] if numbered else line
    pattern_id = int(numbered[1]) if numbered else ord
    wrapped = re.fullmatch(r"/(.*)/([^/]*)", body, re.DOTALL)
    if not wrapped:
        return Rule(ord, pattern_id, body, kind=kind)
    expression, rest = wrapped[1], wrapped[2]
    flags, ext = rest, {}
    if kind == "regex" and rest.endswith("}") and "{" in rest:
        flags, inside = rest[:-1].rsplit("{", 1)
        for item in filter(None, inside.split(",")):
            key, _, value = item.partition("=")
            if key not in EXT_KEYS or not value.isdecimal():
                raise RuleError(f"unexpected constraint {item!r}", ord)
            ext[key] = int(value)
    unknown = set(flags) - set(FLAGS[kind])
    if unknown:
        raise RuleError(f"invalid flag {sorted(unknown)[0]!r}", ord)
    return Rule(ord, pattern_id, expression, frozenset(flags), kind, ext)


def rule_list(source, kind: str = "regex") -> list[Rule]:
    """Rules from a line, a sequence of lines / dicts / Rules, or a rule table."""
    if isinstance(source, DataFrame):
        return collect_rules(source)
    if isinstance(source, (str, Rule, dict)):
        source = [source]
    out: list[Rule] = []
    for item in source:
        at = len(out)
        if isinstance(item, Rule):
            out.append(Rule(at, item.pattern_id, item.expression, item.flags, item.kind, item.ext, item.som))
        elif isinstance(item, dict):
            given = item.get("pattern_id")
            ext = {k: v for k, v in (item.get("ext") or {}).items() if v is not None}
            out.append(Rule(at, at if given is None else given, item["expression"],
                            frozenset(item.get("flags") or ()), item.get("kind") or kind, ext, item.get("som")))
        else:
            text = item.strip()
            if text and not text.startswith("#"):
                out.append(parse_line(text, at, kind))
    return out


def single(expression: str, flags: str = "") -> list[Rule]:
    """One expression on its own reports id 0 whatever id it was written with."""
    rule = parse_line(expression) if not flags else Rule(0, 0, expression, frozenset(flags))
    return [Rule(0, 0, rule.expression, rule.flags, rule.kind, rule.ext, rule.som)]


def rules_table(spark: SparkSession, source, kind: str = "regex") -> DataFrame:
    if isinstance(source, DataFrame):
        return source.select(*RULES_SCHEMA.names)
    return spark.createDataFrame([r.row() for r in rule_list(source, kind)], RULES_SCHEMA)


def collect_rules(rules: DataFrame) -> list[Rule]:
    rows = rules.select(*RULES_SCHEMA.names).orderBy("ord").limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise RuleError(f"more than {MAX_RULES} rules; only plain texts (literal_scan, phrase_scan) may be more")
    return [
        Rule(r.ord, r.ord if r.pattern_id is None else r.pattern_id, r.expression, frozenset(r.flags or ()),
             r.kind or "regex", {k: v for k, v in (r.ext.asDict() if r.ext else {}).items() if v is not None}, r.som)
        for r in rows
    ]


def check_rules(rules: list[Rule]) -> None:
    """Report the first rule that cannot be used, by its position."""
    for rule in rules:
        if rule.flags & {"C"}:
            continue
        rule.prepared()
        if rule.ext.get("edit_distance") and rule.ext.get("hamming_distance"):
            raise RuleError("edit and hamming distance exclude each other", rule.ord)


def union_rules(*parts: DataFrame) -> DataFrame:
    """One rule set from several; positions are renumbered, ids kept.

    Offsets come from each part's largest position, so no part is numbered in
    a single task.
    """
    out = None
    for part in parts:
        part = part.select(*RULES_SCHEMA.names)
        if out is None:
            out = part
            continue
        shift = out.agg(F.coalesce(F.max("ord"), F.lit(-1)) + 1).scalar()
        moved = part.withColumn("ord", (F.col("ord") + shift).cast("int"))
        out = out.unionByName(moved.select(*RULES_SCHEMA.names))
    return out


def exclude_rules(rules: DataFrame, excluded: DataFrame) -> DataFrame:
    return rules.join(excluded.select("pattern_id").distinct(), "pattern_id", "left_anti").select(*rules.columns)


def horizon_bytes(rules: list[Rule]) -> int | None:
    """The set's horizon in bytes; ``None`` if starts are never too far back."""
    name = som_horizon(rules)
    return SOM_HORIZONS[name] if name else None


def som_horizon(rules: list[Rule]) -> str | None:
    """Horizon of the whole set: the largest any rule asks for, medium if none does; ``None`` if no rule reports starts."""
    if not any("L" in r.flags for r in rules):
        return None
    return max((r.som for r in rules if r.som), key=("small", "medium", "large").index, default="medium")
