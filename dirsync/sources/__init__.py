"""Reading of snapshots and state, writing of the directory and its reports."""

from .readers import load_directory, load_rosters, load_sales, load_state  # noqa: F401
from .versions import compact_state, current, publish, read_state, write_state  # noqa: F401
from .writers import publish_directory, write_directory, write_reports, write_sales  # noqa: F401
