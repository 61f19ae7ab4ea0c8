"""Hourly readings analytics as Spark DataFrame operators.

Long readings ``(period, respondent, type, value)`` become per-metric hourly
tables (Silver) and daily, hourly and per-region analytics (Gold). Every
operator takes and returns lazy DataFrames; only ``plans`` and
``sources.store`` run jobs.
"""

from gridpulse.errors import DataQualityError
from gridpulse.session import build_session, prepare_session

__all__ = ["DataQualityError", "build_session", "prepare_session"]
