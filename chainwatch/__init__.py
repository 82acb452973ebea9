"""Markov-chain sequence anomaly detection on Spark DataFrames."""

from .config import DEFAULT_STATES, MarkovConfig

__all__ = ["MarkovConfig", "DEFAULT_STATES"]
