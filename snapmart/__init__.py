"""snapmart: catalogues whose items are measured again and again, on PySpark."""

from snapmart.roles import Roles, Tables
from snapmart.session import build_session

__all__ = ["Roles", "Tables", "build_session"]
