"""Rule lines as data: parse, format, load, store, snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import spans as S
from ..operators.rules import EXT_KEYS, EXT_TYPE, FLAGS, RULES_SCHEMA

LINE = r"(?s)^/(.*)/([^/]*)$"


def _blank_as_null(c: Column) -> Column:
    return F.when(c != "", c)


def parse_rules(lines: DataFrame, kind: str = "regex", *, line: str = "line", ord: str = "ord",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Rule table from a table of rule lines; a bad line fails the query with its position.

    Blank lines and lines starting with ``#`` are left out.
    """
    at = F.col(ord).cast("int")
    allowed = "|".join(EXT_KEYS)

    def read(text: Column) -> Column:
        body = F.regexp_replace(text, r"^\d+:(?=/)", "")
        number = _blank_as_null(F.regexp_extract(text, r"^(\d+):/", 1)).cast("int")
        heads = F.struct(
            text.alias("text"), F.coalesce(number, at).alias("id"), body.rlike(LINE).alias("wrapped"),
            F.regexp_extract(body, LINE, 1).alias("inner"), F.regexp_extract(body, LINE, 2).alias("tail"), body.alias("body"))
        return S.let(heads, split)

    def split(h: Column) -> Column:
        bracketed = F.lit(kind == "regex") & h["tail"].endswith("}") & h["tail"].contains("{")
        flags = F.when(bracketed, F.regexp_replace(h["tail"], r"\{[^{]*\}$", "")).otherwise(h["tail"])
        ext = F.when(bracketed, F.regexp_extract(h["tail"], r"\{([^{]*)\}$", 1)).otherwise(F.lit(""))
        return S.let(F.struct(h.alias("h"), flags.alias("flags"), ext.alias("ext")), rule)

    def rule(r: Column) -> Column:
        h = r["h"]
        good = r["flags"].rlike(f"^[{FLAGS[kind]}]*$") & r["ext"].rlike(rf"^(?:(?:{allowed})=\d+(?:,(?=.)|$))*$")
        problem = F.concat(F.lit("rule "), at.cast("string"), F.lit(": cannot read "), h["text"])
        expression = F.when(h["wrapped"], h["inner"]).otherwise(h["body"])
        return F.struct(
            at.alias("ord"), h["id"].alias("pattern_id"), F.lit(kind).alias("kind"),
            F.when(good, expression).otherwise(F.raise_error(problem).cast("string")).alias("expression"),
            F.filter(F.array(*[F.lit(f) for f in FLAGS["regex"]]), lambda f: r["flags"].contains(f)).alias("flags"),
            F.struct(*[
                _blank_as_null(F.regexp_extract(r["ext"], rf"\b{f.name}=(\d+)", 1)).cast(f.dataType).alias(f.name)
                for f in EXT_TYPE.fields
            ]).alias("ext"),
            F.lit(None).cast("string").alias("som"))

    texts = F.filter(F.array(F.trim(F.col(line))), lambda t: (t != "") & ~t.startswith("#"))
    parsed = lines.select(*keep, F.inline(F.transform(texts, read)))
    return parsed.select(*RULES_SCHEMA.names, *keep)


def format_rules(rules: DataFrame, *, line: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rule lines from a rule table, in the form :func:`parse_rules` reads.

    An id equal to the rule's position is the default and is not written.
    """
    letters = F.concat_ws("", F.filter(
        F.array(*[F.lit(f) for f in FLAGS["regex"]]), lambda f: F.array_contains(F.col("flags"), f)))
    pairs = F.concat_ws(",", *[
        F.when(F.col(f"ext.{k}").isNotNull(), F.concat(F.lit(f"{k}="), F.col(f"ext.{k}").cast("string")))
        for k in EXT_KEYS
    ])
    ext = F.when(pairs != "", F.concat(F.lit("{"), pairs, F.lit("}"))).otherwise(F.lit(""))
    own_id = F.when(F.col("pattern_id") != F.col("ord"), F.concat(F.col("pattern_id").cast("string"), F.lit(":")))
    own_id = F.coalesce(own_id, F.lit(""))
    # an expression that would itself read as wrapped, numbered or a comment needs delimiters
    ambiguous = F.col("expression").rlike(r"(?s)^(?:/.*/[^/]*|\d+:/.*|#.*|\s.*|.*\s)$")
    bare = (own_id == "") & (letters == "") & (ext == "") & ~ambiguous
    written = F.concat(own_id, F.lit("/"), F.col("expression"), F.lit("/"), letters, ext)
    return rules.select("ord", F.when(bare, F.col("expression")).otherwise(written).alias(line), *keep)


def load_rules(spark: SparkSession, path: str, kind: str = "regex") -> DataFrame:
    """Rule file or folder: one rule per line, positions counted over the lines that hold a rule, files in the order of their names.

    Lines are numbered within the splits they are read in, and splits by their place.
    """
    split = ["__file", "__at"]
    lines = spark.read.text(path).select(
        "value", F.monotonically_increasing_id().alias("__line"), F.col("_metadata.file_name").alias("__file"),
        F.col("_metadata.file_block_start").alias("__at"))
    kept = lines.where(~F.trim("value").rlike(r"^(?:#.*)?$"))
    inside = kept.withColumn("__n", F.row_number().over(Window.partitionBy(*split).orderBy("__line")) - 1)
    # a row for each split of the files
    earlier = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    before = kept.groupBy(*split).agg(F.count("*").alias("__c")).select(
        *split, F.coalesce(F.sum("__c").over(earlier), F.lit(0)).alias("__before"))
    numbered = inside.join(before, split).withColumn("ord", (F.col("__before") + F.col("__n")).cast("int"))
    return parse_rules(numbered, kind, line="value")


def store_rules(rules: DataFrame, path: str) -> None:
    """A folder of rule files; their names follow rule order."""
    format_rules(rules).orderBy("ord").select("line").write.mode("overwrite").text(path)


def save_snapshot(rules: DataFrame, path: str, version: int = 0) -> None:
    rules.select(*RULES_SCHEMA.names).write.mode("overwrite").parquet(f"{path}/version={version}")


def load_snapshot(spark: SparkSession, path: str, version: int = 0) -> DataFrame:
    return spark.read.schema(RULES_SCHEMA).parquet(f"{path}/version={version}")


def snapshot_info(rules: DataFrame) -> DataFrame:
    """One row: number of rules, their kinds, and a checksum independent of row order."""
    checksum = F.bit_xor(F.xxhash64("ord", "pattern_id", "kind", "expression", F.concat_ws("", "flags"), "ext"))
    return rules.agg(
        F.count("*").alias("rules"),
        F.array_sort(F.collect_set("kind")).alias("kinds"),
        checksum.alias("checksum"),
    )
