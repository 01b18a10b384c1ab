"""Inputs: match logs and ratings."""

from courtlens.sources.tables import read_match_logs, read_ratings

__all__ = ["read_match_logs", "read_ratings"]
