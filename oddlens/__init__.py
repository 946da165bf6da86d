"""Risk-table analytics on Spark: profile, bin, measure, split, select, score."""

from oddlens.operators.contract import (
    ContractError,
    RiskContract,
    ValidatedContract,
    validate_contract,
)

__all__ = ["ContractError", "RiskContract", "ValidatedContract", "validate_contract"]
