"""Data-freshness analytics on Spark DataFrames.

An inventory says what should be reporting; one or two observed sources say
what did.  The package labels every inventory record MISSING, STALE or healthy
against an age threshold, keeps the findings, and reports on them.
"""

from tidemark.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
