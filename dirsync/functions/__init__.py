"""Column functions: every one takes and returns native Spark columns."""

from .text import (  # noqa: F401
    clean_title,
    display_name,
    event_line,
    first_nonblank,
    fmt_phone,
    in_list_ci,
    infer_region,
    joined_name,
    name_key,
    null_if_blank,
    slugify,
    split_list,
    strip,
    strip_prefix,
    truthy,
)
from .times import age_seconds, parse_iso, stamp  # noqa: F401
from .urls import entity_key, host_class, html_text, is_self_hosted, is_trusted, url_hash, valid_url  # noqa: F401
from .sales import addr_query, fmt_price, strip_house_no  # noqa: F401
