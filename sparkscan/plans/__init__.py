"""Registered queries; importing the modules fills the registry."""

from . import analysis_queries, modifier_queries, rule_queries, scan_queries, stream_queries
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "analysis_queries", "modifier_queries", "rule_queries", "scan_queries", "stream_queries"]
