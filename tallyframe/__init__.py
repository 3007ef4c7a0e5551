"""Profiling, preparation and scoring of labelled tables on Spark."""

from tallyframe.session import get_session
from tallyframe.spec import TableSpec

__all__ = ["TableSpec", "get_session"]
