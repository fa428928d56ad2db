"""Spark-native analytics for high-rate position tracking in team sports."""

from trackspark.config import MATCH, MatchConfig
from trackspark.session import build_session

__all__ = ["MATCH", "MatchConfig", "build_session"]
