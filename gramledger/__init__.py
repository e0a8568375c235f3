"""Incremental four-word phrase statistics over reference-counted documents."""

from gramledger.config import LedgerOptions
from gramledger.plans.ledger import Ledger

__all__ = ["Ledger", "LedgerOptions"]
