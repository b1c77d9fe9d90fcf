"""Rule tables and switches of a directory sync.

Everything here is data: lists, maps and names that an operator of the
directory edits.  The values a deployment uses are passed in; the defaults are
neutral and invented.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Labels written into the directory and its reports.
DEFAULT_TITLE = "REALTOR®"
GENERIC_TITLES = ("REALTOR", "AGENT", "")
TITLE_SUFFIX = " / Agent"
FLAG_JUNK = "JUNK_ACCOUNT"
FLAG_NO_REGION = "NO_REGION"
FLAG_MISSING = "MISSING_DATA"
FLAG_DUPLICATE = "POTENTIAL_DUPLICATE"


@dataclass(frozen=True)
class SyncConfig:
    """Rules of the roster-to-directory sync."""

    # Accounts, in order of authority, and the source tag each one writes.
    main_account: str = "main"
    second_account: str = "second"
    second_enabled: bool = True
    main_source: str = "main"
    second_source: str = "second"
    both_source: str = "both"
    joint_source: str = "joint"
    sheet_source: str = "sheet"
    second_region: str = "Second"

    # Cleaning.
    allowed_roles: tuple[str, ...] = ("agent", "team leader", "broker")
    office_regions: tuple[tuple[str, str], ...] = ()
    team_logos: dict[str, str] = field(default_factory=dict)
    hide_team_names: tuple[str, ...] = ()
    hide_team_ids: tuple[str, ...] = ()
    suppressed_ids: tuple[str, ...] = ()
    default_title: str = DEFAULT_TITLE
    generic_titles: tuple[str, ...] = GENERIC_TITLES
    title_suffix: str = TITLE_SUFFIX

    # Junk rules, in the order they are tried.
    junk_email_patterns: tuple[str, ...] = ()
    junk_name_patterns: tuple[str, ...] = ()
    staff_email_patterns: tuple[str, ...] = ()
    house_domain: str = "@house.example.com"

    # Matching and lifecycle.
    manual_pairs: dict[str, str] = field(default_factory=dict)
    joint_emails: tuple[str, ...] = ()
    soft_delete_second_region: bool = True
    grace_days: int = 30
    page_base: str = "https://pages.example.com"
    url_recheck_seconds: int = 3600

    # Publishing.
    min_rows: int = 50
    min_share: float = 0.50


@dataclass(frozen=True)
class AssetConfig:
    """Rules of the photo jobs."""

    source_a: str = "source_a"
    source_b: str = "source_b"
    excluded_sources: tuple[str, ...] = ("second", "second_sheet")
    self_host_marks: tuple[str, str] = ("directory-data", "/photos/")
    public_base: str = "https://static.example.com/directory-data/photos"
    asset_dir: str = "/photos/"
    asset_suffix: str = ".jpg"
    trusted_hosts: tuple[str, ...] = ("cdn.trusted.example", "cdn.legacy.example")
    optimise_prefix: str = "https://uploads.example.com/avatars/"
    page_anchor: str = r'<div\s+class="agent-card"'
    cache_ttl_seconds: int = 7 * 86400


@dataclass(frozen=True)
class SalesConfig:
    """Rules of the public sales table."""

    keep_words: tuple[str, ...] = ("residential", "traditional", "single")
    default_state: str = "OH"
