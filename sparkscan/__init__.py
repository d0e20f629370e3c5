"""Scan tables and streams with sets of patterns, as Spark DataFrames."""

from .functions.facade import Regex
from .functions.regex import RuleError, prepare
from .operators.control import handled_scan
from .operators.phrases import phrase_scan
from .operators.rules import Rule, check_rules, exclude_rules, rule_list, rules_table, union_rules
from .operators.scan import grep, hit_counts, literal_counts, literal_scan, pcre_scan, scan, scan_one, vectored_scan
from .streaming.batch import stream_scan
from .streaming.live import live_scan

__all__ = [
    "Regex", "Rule", "RuleError", "check_rules", "exclude_rules", "grep", "handled_scan", "hit_counts", "literal_counts",
    "literal_scan", "live_scan", "pcre_scan", "phrase_scan", "prepare", "rule_list", "rules_table", "scan", "scan_one",
    "stream_scan", "union_rules", "vectored_scan",
]
