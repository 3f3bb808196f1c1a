"""The comparison with DuckDB that the other tests use."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from compare import connection, differences  # noqa: E402, F401
