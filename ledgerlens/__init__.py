"""Spark analytics over a wallet movement ledger."""

from ledgerlens.functions.rules import Rules
from ledgerlens.operators.classify import classify

__all__ = ["Rules", "classify"]
