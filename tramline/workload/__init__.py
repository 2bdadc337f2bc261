"""Every operator on the driver's tables, each with the SQL that must give the same rows."""

from tramline.workload import (  # noqa: F401  (registration)
    models,
    reading,
    relations,
    scalars,
    writing,
)
from tramline.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
