"""Behavioural analytics over card transactions, written for Spark."""

from spendscope.params import Params

__all__ = ["Params"]
