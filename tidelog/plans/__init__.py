"""The registered queries, each with the SQL that must give the same rows."""

from tidelog.plans import attest, branches, metrics, reads, schemas, search, sql, streams  # noqa: F401
from tidelog.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
