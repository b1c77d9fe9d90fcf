"""Keep a published directory in step with the snapshots it is drawn from."""

from .config import AssetConfig, SalesConfig, SyncConfig  # noqa: F401
