"""Operators and jobs applied to the driver tables. Importing registers every query."""

from portfolio_ops.analogues import (  # noqa: F401
    homeowners, jobs, ledger, operators, policy, publishing, stream, vault, vault_whole)
from portfolio_ops.analogues.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
