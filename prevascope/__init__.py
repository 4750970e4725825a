"""Prevalence analytics on Spark: rank, profile and score entities within their groups."""

from prevascope.config import DEFAULT_CONFIG, PrevalenceConfig, RankedMeasure

__all__ = ["DEFAULT_CONFIG", "PrevalenceConfig", "RankedMeasure"]
