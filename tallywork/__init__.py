"""Tabular analysis on Spark: clean, profile, test, chart data, classify, report."""

from tallywork.spec import CENSUS_INCOME, CENSUS_INCOME_SCHEMA, AnalysisSpec

__all__ = ["AnalysisSpec", "CENSUS_INCOME", "CENSUS_INCOME_SCHEMA"]
