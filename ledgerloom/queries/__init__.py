"""Every registered query; importing a module registers its queries."""

from ledgerloom.queries import (  # noqa: F401
    aggregates,
    invoicing,
    joining,
    projections,
    reports,
    scalars,
    transforms,
)
from ledgerloom.queries.base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
