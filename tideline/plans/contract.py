"""All registered queries."""

from tideline.plans import contract_changelog, contract_streams, contract_text  # noqa: F401
from tideline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
