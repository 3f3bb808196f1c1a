"""Every query over the driver's tables, next to the SQL that must give the same rows."""

from snapmart_checks.base import REGISTRY, Check
from snapmart_checks import changes, feeds, layouts, operators, plans, stores  # noqa: F401  (they fill REGISTRY)

__all__ = ["REGISTRY", "Check"]
