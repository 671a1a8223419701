"""pactum: contract checking and risk scoring as Spark jobs.

Public functions take and return DataFrames; contracts are Spark SQL text.
"""

from pactum.operators.contracts import Contract, check_contracts
from pactum.policy import Policy

__all__ = ["Contract", "Policy", "check_contracts"]
