"""Whole jobs, put together from the operators."""

from .photos import run_photos, run_scrape  # noqa: F401
from .sold import run_sales  # noqa: F401
from .sync import PublishRefused, plan_sync, run_sync  # noqa: F401
