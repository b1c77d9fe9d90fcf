"""SQL that DuckDB runs on the same tables, one text per registered query.

The texts are written from the rules, not from the Spark code: joins where Spark
aggregates, windows where Spark joins.
"""

from __future__ import annotations

import re
from datetime import timedelta

from dirsync.operators.entities import REFERENCE, code_page_texts, entity_names
from dirsync.sources.readers import ACCOUNT_SPAN

from .fixtures import FIXTURES, duck_sql, parents, with_clause
from .settings import ASSET, NOW, RUN, SALES, SYNC, YEAR

NOW_TS = f"TIMESTAMPTZ '{NOW.isoformat()}'"
NOW_TEXT = NOW.isoformat()


def text(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def texts(values) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


def trimmed(c: str) -> str:
    return f"trim(coalesce({c}, ''))"


def unprefixed(c: str) -> str:
    return f"trim(regexp_replace({trimmed(c)}, '^0[0-9]+ - ', ''))"


def first_of(*cs: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({c}, '')" for c in cs) + ", '')"


def key_of(c: str) -> str:
    return f"regexp_replace(lower(coalesce({c}, '')), '[^a-z]', '', 'g')"


def slug_of(c: str) -> str:
    bare = f"replace(replace(trim(lower({c})), '''', ''), '’', '')"
    return f"trim(regexp_replace({bare}, '[^a-z0-9]+', '-', 'g'), '-')"


def phone_of(c: str) -> str:
    d = f"regexp_replace({c}, '[^0-9]', '', 'g')"
    local = f"CASE WHEN length({d}) = 11 AND {d}[1] = '1' THEN {d}[2:] ELSE {d} END"
    return (
        f"CASE WHEN length({local}) = 10 THEN '(' || ({local})[1:3] || ') ' || ({local})[4:6] || '-' || ({local})[7:10]"
        f" ELSE coalesce({c}, '') END"
    )


def title_of(c: str) -> str:
    kept = f"trim(replace(coalesce({c}, ''), {text(SYNC.title_suffix)}, ''))"
    return (
        f"CASE WHEN upper(coalesce({c}, '')) IN ('REALTOR', 'AGENT', '') OR {kept} = ''"
        f" THEN {text(SYNC.default_title)} ELSE {kept} END"
    )


def region_of(c: str) -> str:
    return "CASE " + " ".join(
        f"WHEN contains(lower({c}), {text(w)}) THEN {text(r)}" for w, r in SYNC.office_regions
    ) + " END"


def list_of(c: str) -> str:
    return (
        f"list_filter(list_transform(string_split(coalesce({c}, ''), ','), lambda x: trim(x)), lambda x: x <> '')"
    )


def iso(c: str) -> str:
    return f"try_cast({c} AS TIMESTAMPTZ)"


def hosted(c: str) -> str:
    return "(" + " AND ".join(f"contains(coalesce({c}, ''), {text(m)})" for m in ASSET.self_host_marks) + ")"


def trusted(c: str) -> str:
    return "(" + " OR ".join(f"contains(coalesce({c}, ''), {text(h)})" for h in ASSET.trusted_hosts) + ")"


def joined(c: str) -> str:
    return f"array_to_string({c}, '|')"


ROLE_OK = f"lower({trimmed('role')}) IN {texts(SYNC.allowed_roles)}"
PHOTO = first_of("profile_picture_url", "photo_url", "avatar_url", "image_url")
PRICE = "coalesce(nullif(price, 0), nullif(sales_volume, 0), 0)"
TYPE_OK = "(coalesce(transaction_type, '') = '' OR regexp_matches(lower(transaction_type), 'residential|traditional|single'))"
SALE_OK = f"({PRICE} > 0 AND {trimmed('address')} <> '' AND {trimmed('city')} <> '')"
QUERY = f"{trimmed('address')} || ', ' || {trimmed('city')} || ', ' || coalesce(state, 'OH') || ' ' || coalesce(zip, '')"
STREET = r"trim(regexp_replace(trim(address), '^\s*#?\d+[A-Za-z]?(?:[-–/]\d+[A-Za-z]?)?\s+', ''))"
DIR_TEXT = (
    "email, name, phone, title, team, team_logo, array_to_string(regions, '|') AS regions, office, photo, page_url, id, "
    "second_id, source, photo_source, photo_hash, hidden, soft_deleted_at, extras"
)
ASSET_KEY = "coalesce(nullif(trim(id), ''), 'email-' || sha256(nullif(trim(lower(email)), '')))"


def junk_cases() -> str:
    cases = [
        *[f"WHEN regexp_matches(email, {text(p)}) THEN {text('email matches junk pattern: ' + p)}" for p in SYNC.junk_email_patterns],
        *[f"WHEN regexp_matches(lower(name), {text(p)}) THEN {text('name matches junk pattern: ' + p)}" for p in SYNC.junk_name_patterns],
        *[f"WHEN regexp_matches(email, {text(p)}) THEN {text('staff/internal account: ' + p)}" for p in SYNC.staff_email_patterns],
        f"WHEN regexp_matches(name, '^0[0-9][0-9] - ') AND NOT ends_with(email, {text(SYNC.house_domain)})"
        " THEN 'numbered prefix account with no brokerage email'",
    ]
    return "CASE " + " ".join(cases) + " END"


ASSIGNED = f"""
CASE WHEN account = 'second' AND NOT list_contains(filled, {text(SYNC.second_region)})
     THEN list_prepend({text(SYNC.second_region)}, filled) ELSE filled END
"""

POOL: dict[str, str] = {
    **FIXTURES,
    "o_names": f"""
SELECT *, {unprefixed('first_name')} AS f0, {unprefixed('last_name')} AS l0, {unprefixed('preferred_name')} AS p0
FROM fx_roster_a
""",
    "o_shown": f"""
SELECT *, trim(CASE WHEN p0 <> '' THEN p0 ELSE f0 END || ' ' || l0) AS j0 FROM o_names
""",
    "o_placed": f"""
SELECT *,
       nullif(trim(regexp_replace(CASE WHEN j0 <> '' THEN j0 ELSE {trimmed('name')} END, '^0[0-9]+ - ', '')), '') AS shown,
       {first_of('team', 'team_alt', 'team_name')} AS team0,
       {first_of('office', 'office_name')} AS office0,
       {list_of(first_of('region', 'region_alt'))} AS declared
FROM o_shown
""",
    "o_filled": f"""
SELECT *, CASE WHEN len(declared) = 0 AND {region_of('office0')} IS NOT NULL
               THEN [{region_of('office0')}] ELSE declared END AS filled
FROM o_placed
""",
    "o_clean": f"""
SELECT pos, lower({trimmed('email')}) AS email, shown AS name,
       trim({trimmed('first_name')} || ' ' || {trimmed('last_name')}) AS raw_name,
       {phone_of(first_of('phone', 'phone_number'))} AS phone,
       {title_of('title')} AS title,
       CASE WHEN lower(trim(team0)) IN {texts(v.lower() for v in SYNC.hide_team_names)} OR id IN {texts(SYNC.hide_team_ids)}
            THEN '' ELSE team0 END AS team,
       {ASSIGNED} AS regions, office0 AS office,
       nullif(id, '') AS id,
       CASE WHEN regexp_matches({PHOTO}, '^https?://') THEN {PHOTO} ELSE '' END AS incoming_photo,
       coalesce(avatar_added, false) AS incoming_photo_real,
       CASE WHEN account = 'second' THEN 'second' ELSE 'main' END AS source,
       {trimmed('role')} AS role,
       CASE WHEN {trimmed('email')} = '' THEN 'blank_email'
            WHEN id IN {texts(SYNC.suppressed_ids)} THEN 'suppressed'
            WHEN active = false THEN 'inactive'
            WHEN shown IS NULL THEN 'blank_name'
            WHEN {trimmed('role')} <> '' AND NOT {ROLE_OK} THEN 'role' END AS dropped
FROM o_filled
""",
    "o_logos": "SELECT * FROM (VALUES " + ", ".join(f"({text(t)}, {text(u)})" for t, u in SYNC.team_logos.items()) + ") t(team, logo)",
    "o_parsed": """
SELECT c.pos, email, name, phone, title, c.team, coalesce(l.logo, '') AS team_logo, regions, office, '' AS photo,
       '' AS page_url, id, incoming_photo, incoming_photo_real, '' AS second_id, source
FROM o_clean c LEFT JOIN o_logos l ON l.team = c.team WHERE dropped IS NULL
""",
    "o_judged": f"""
SELECT *, {junk_cases()} AS junk,
       array_to_string(list_filter([
         CASE WHEN office = '' AND NOT mute THEN 'no_office' END,
         CASE WHEN phone = '' THEN 'no_phone' END,
         CASE WHEN team = '' AND NOT mute THEN 'no_team' END], lambda x: x IS NOT NULL), ', ') AS missing
FROM (SELECT *, source = 'second' OR list_contains(regions, {text(SYNC.second_region)}) AS mute FROM o_parsed)
""",
    "o_valid": "SELECT * FROM o_judged WHERE junk IS NULL AND len(regions) > 0",
    "o_dups": f"""
SELECT first_value(name) OVER (PARTITION BY email ORDER BY pos) AS name, email, pos, nk,
       count(*) OVER (PARTITION BY nk) AS n
FROM (SELECT *, {key_of('name')} AS nk FROM o_valid)
""",
    "o_dup_flags": """
SELECT d.name, d.email, 'Same name found with ' || d.n || ' different emails: all rows of name key ' || d.nk AS reason, d.pos
FROM o_dups d
WHERE d.n > 1 AND d.nk <> ''
""",
    "o_flags": """
SELECT name, email, id, NULL AS office, NULL AS team, NULL AS regions, 'JUNK_ACCOUNT' AS flag, junk AS reason,
       'Excluded from the directory. Review in the source system.' AS action, pos
FROM o_judged WHERE junk IS NOT NULL
UNION ALL
SELECT name, email, id, office, team, NULL, 'NO_REGION', 'No region assigned in the source system',
       'Excluded from site. Assign a region in the source system to make visible.', pos
FROM o_judged WHERE junk IS NULL AND len(regions) = 0
UNION ALL
SELECT name, email, id, office, team, array_to_string(regions, '|'), 'MISSING_DATA', missing,
       'Shown on site. Update the profile in the source system.', pos
FROM o_valid WHERE missing <> ''
UNION ALL
SELECT name, email, NULL, NULL, NULL, NULL, 'POTENTIAL_DUPLICATE', reason,
       'Verify these are different people or merge/deactivate in the source system.', pos
FROM o_dup_flags
""",
    "o_dir": f"""
SELECT * REPLACE ({list_of('regions')} AS regions),
       CASE WHEN extra_status IS NOT NULL THEN 'status=' || extra_status END AS extras
FROM fx_directory
""",
    "o_email_idx": "SELECT lower(email) AS key, max(pos) AS row_id FROM o_dir WHERE email <> '' GROUP BY 1",
    "o_id_idx": "SELECT id AS key, max(pos) AS row_id FROM o_dir WHERE id <> '' GROUP BY 1",
    "o_name_idx": f"""
SELECT nk AS key, max(pos) AS row_id FROM (SELECT {key_of('name')} AS nk, pos FROM o_dir)
WHERE nk <> '' GROUP BY 1 HAVING count(*) = 1
""",
    "o_pairs": "SELECT id, " + key_of("old_name") + " AS target FROM (VALUES "
    + ", ".join(f"({text(i)}, {text(n)})" for i, n in SYNC.manual_pairs.items())
    + ") t(id, old_name)",
    "o_manual": """
SELECT v.pos AS in_pos, v.id, m.row_id FROM o_valid v JOIN o_pairs p ON p.id = v.id JOIN o_name_idx m ON m.key = p.target
""",
    "o_matches": f"""
SELECT v.pos AS in_pos, coalesce(m.row_id, i.row_id, e.row_id, n.row_id) AS row_id,
       CASE WHEN m.row_id IS NOT NULL THEN 0 WHEN i.row_id IS NOT NULL THEN 1
            WHEN e.row_id IS NOT NULL THEN 2 ELSE 3 END AS tier
FROM o_valid v
LEFT JOIN o_manual m ON m.in_pos = v.pos
LEFT JOIN o_id_idx i ON i.key = v.id
LEFT JOIN o_email_idx e ON e.key = v.email
LEFT JOIN o_name_idx n ON n.key = {key_of('v.name')}
WHERE coalesce(m.row_id, i.row_id, e.row_id, n.row_id) IS NOT NULL
""",
    "o_attached": f"""
SELECT v.*, d.pos IS NOT NULL AS matched, d.team AS p_team, d.team_logo AS p_logo, d.office AS p_office,
       d.title AS p_title, d.regions AS p_regions, d.extras AS p_extras, d.photo AS p_photo, d.page_url AS p_page,
       d.second_id AS p_second_id, d.source AS p_source, d.photo_source AS p_photo_source, d.photo_hash AS p_hash,
       d.hidden AS p_hidden, coalesce(d.soft_deleted_at, '') AS p_deleted,
       coalesce(d.pos IS NOT NULL AND v.source = 'second'
         AND (d.source IN ('sheet', 'second', 'both') OR list_contains(d.regions, {text(SYNC.second_region)})), false) AS pin
FROM o_valid v LEFT JOIN o_matches m ON m.in_pos = v.pos LEFT JOIN o_dir d ON d.pos = m.row_id
""",
    "o_pinned": f"""
SELECT * REPLACE (
         CASE WHEN pin THEN coalesce(p_team, team) ELSE team END AS team,
         CASE WHEN pin THEN coalesce(p_logo, team_logo) ELSE team_logo END AS team_logo,
         CASE WHEN pin THEN coalesce(p_office, office) ELSE office END AS office,
         CASE WHEN pin THEN coalesce(p_title, title) ELSE title END AS title,
         CASE WHEN NOT pin THEN regions WHEN len(p_regions) > 0 THEN p_regions
              ELSE [{text(SYNC.second_region)}] END AS regions),
       CASE WHEN pin THEN p_extras END AS extras
FROM o_attached
""",
    "o_fields": """
SELECT email, name, phone, title, team,
       CASE WHEN NOT matched THEN team_logo WHEN coalesce(team, '') = '' THEN ''
            WHEN coalesce(p_logo, '') <> '' THEN p_logo ELSE team_logo END AS team_logo,
       regions, office,
       CASE WHEN coalesce(p_photo, '') <> '' THEN p_photo WHEN incoming_photo_real THEN incoming_photo ELSE '' END AS photo,
       coalesce(p_page, '') AS page_url, id, coalesce(p_second_id, '') AS second_id,
       CASE WHEN p_source = 'both' AND source <> 'second' THEN 'both' ELSE source END AS source,
       coalesce(p_photo_source, '') AS photo_source, coalesce(p_hash, '') AS photo_hash,
       CASE WHEN matched AND p_deleted <> '' THEN false ELSE coalesce(p_hidden, false) END AS hidden,
       CAST(NULL AS VARCHAR) AS soft_deleted_at, extras, 0 AS seq, pos,
       CASE WHEN NOT matched THEN 'new' WHEN p_deleted <> '' THEN 'reactivated' ELSE 'updated' END AS fate,
       nullif(p_deleted, '') AS was_deleted_at
FROM o_pinned
""",
    "o_paged": f"""
SELECT * REPLACE (CASE WHEN wants THEN {text(SYNC.page_base + '/')} || {slug_of('name')} ELSE page_url END AS page_url)
FROM (SELECT *, page_url = '' AND NOT hidden AND NOT list_contains(regions, {text(SYNC.second_region)})
                AND source NOT IN ('sheet', 'second') AND {slug_of('name')} <> '' AS wants FROM o_fields)
""",
    "o_gone": f"""
SELECT *, list_contains(regions, {text(SYNC.second_region)}) OR source = 'sheet' AS regional
FROM o_dir WHERE pos NOT IN (SELECT row_id FROM o_matches)
""",
    "o_fated": f"""
SELECT *, CASE WHEN lower(email) IN {texts(SYNC.joint_emails)} AND source = 'joint' THEN 'joint'
               WHEN {iso('soft_deleted_at')} < {NOW_TS} - INTERVAL {SYNC.grace_days} DAY THEN 'purge'
               WHEN {iso('soft_deleted_at')} IS NOT NULL THEN 'grace'
               ELSE 'soft_delete' END AS fate
FROM o_gone
""",
    "o_carried": f"""
SELECT email, name, phone, title, team, team_logo, regions, office, photo, page_url, id, second_id, source,
       photo_source, photo_hash, CASE WHEN fate = 'soft_delete' THEN true ELSE hidden END AS hidden,
       CASE WHEN fate = 'soft_delete' THEN {text(NOW_TEXT)} ELSE soft_deleted_at END AS soft_deleted_at,
       extras, 1 AS seq, pos, fate, nullif(soft_deleted_at, '') AS was_deleted_at
FROM o_fated
""",
    "o_ledger": "SELECT * EXCLUDE (wants) FROM o_paged UNION ALL SELECT * FROM o_carried",
    "o_merged": "SELECT * FROM o_ledger WHERE fate <> 'purge'",
    "o_events": """
SELECT fate AS kind, name, email,
       CASE WHEN fate IN ('new', 'soft_delete') THEN regions END AS regions,
       CASE WHEN fate IN ('new', 'soft_delete') THEN team END AS team,
       CASE WHEN fate = 'new' THEN office END AS office,
       CASE WHEN fate = 'new' THEN id END AS id,
       CASE WHEN fate = 'new' THEN coalesce(photo, '') <> '' END AS has_photo,
       CASE WHEN fate IN ('purge', 'reactivated') THEN was_deleted_at END AS soft_deleted_at, pos
FROM o_ledger WHERE fate IN ('new', 'soft_delete', 'purge', 'reactivated')
""",
    "o_decided": f"""
SELECT *, CASE
  WHEN hidden THEN 'hidden'
  WHEN coalesce(soft_deleted_at, '') <> '' THEN 'soft_deleted'
  WHEN key IS NULL THEN 'no_key'
  WHEN source IN ('second', 'second_sheet') THEN
    CASE WHEN NOT is_real THEN 'second_account_no_photo'
         WHEN photo_source = 'source_a' AND same AND {hosted('photo')} AND stored THEN 'fresh'
         ELSE 'second_account_source_a' END
  WHEN is_real THEN
    CASE WHEN photo_source <> 'source_a' THEN 'upgrade_to_source_a'
         WHEN NOT same THEN 'source_a_changed'
         WHEN {hosted('photo')} AND stored THEN 'fresh' ELSE 'source_a_changed' END
  WHEN {trusted('photo')} THEN 'external_working_photo'
  WHEN {hosted('photo')} THEN CASE WHEN stored THEN 'fresh' ELSE 'no_photo_at_all' END
  WHEN photo = '' THEN 'no_photo_at_all'
  ELSE 'unknown_external_url' END AS reason
FROM (SELECT r.*, {ASSET_KEY} AS key, {ASSET_KEY} IN (SELECT key FROM fx_assets) AS hit,
             coalesce({ASSET_KEY} IN (SELECT key FROM fx_assets), false) AS stored,
             coalesce(incoming_photo_real, false) AND trim(incoming_photo) <> '' AS is_real,
             photo_hash = sha256(trim(incoming_photo)) AS same
      FROM fx_asset_rows r)
""",
    "o_needs": "SELECT *, reason IN ('second_account_source_a', 'upgrade_to_source_a', 'source_a_changed', 'no_photo_at_all') AS needs FROM o_decided",
    "o_queue": "SELECT * FROM o_needs WHERE needs AND key IS NOT NULL",
    "o_tried": f"""
SELECT q.*,
       CASE WHEN NOT coalesce(incoming_photo_real, false) THEN 'not_flagged_real' WHEN trim(incoming_photo) = '' THEN 'no_url'
            WHEN NOT starts_with(trim(incoming_photo), 'http') THEN 'invalid_url'
            WHEN a.key IS NULL THEN 'not_attempted' WHEN NOT a.ok THEN a.reason END AS fail_a,
       CASE WHEN trim(page_url) = '' THEN 'no_page_url' WHEN b.key IS NULL THEN 'page_fetch_failed'
            WHEN NOT b.ok THEN b.reason END AS fail_b,
       b.source_url AS b_url,
       coalesce({RUN} - r.last_run > 0 AND ({RUN} - r.last_run) % 2 = 1, false) AS cooldown
FROM o_queue q LEFT JOIN fx_attempts_a a ON a.key = q.key LEFT JOIN fx_attempts_b b ON b.key = q.key
LEFT JOIN fx_retries r ON r.key = q.key
""",
    "o_outcome": f"""
SELECT *, CASE WHEN fail_a IS NULL THEN 'success_a'
               WHEN source IN ('second', 'second_sheet') THEN 'second_account_source_a_failed'
               WHEN photo_source = 'source_a' THEN 'kept_existing_source_a'
               WHEN cooldown THEN 'source_b_cooldown'
               WHEN fail_b IS NULL THEN 'success_b'
               WHEN {hosted('photo')} AND stored THEN 'kept_existing'
               WHEN photo <> '' THEN 'failed_kept_existing' ELSE 'failed_no_photo' END AS st
FROM o_tried
""",
    "o_asset_events": f"""
SELECT name, key, reason, {text(NOW_TEXT)} AS attempted_at,
       CASE WHEN st LIKE 'success%' THEN 'success' ELSE st END AS status,
       CASE st WHEN 'success_a' THEN 'source_a' WHEN 'success_b' THEN 'source_b' END AS source,
       CASE st WHEN 'success_a' THEN trim(incoming_photo) WHEN 'success_b' THEN b_url END AS source_url,
       fail_a AS failure_a,
       CASE WHEN st IN ('kept_existing', 'failed_kept_existing', 'failed_no_photo') THEN fail_b END AS failure_b,
       CASE WHEN st LIKE 'success%' THEN true
            WHEN st IN ('second_account_source_a_failed', 'kept_existing', 'failed_kept_existing', 'failed_no_photo') THEN false
            END AS recorded,
       CASE WHEN st = 'second_account_source_a_failed' THEN 'A:' || fail_a
            WHEN st IN ('kept_existing', 'failed_kept_existing', 'failed_no_photo') THEN 'A:' || fail_a || ',B:' || fail_b
            END AS retry_reason, pos
FROM o_outcome
""",
    "o_runs": """
SELECT *, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts) = 1 AS first_of_day,
       lag("count") OVER (ORDER BY ts) AS previous FROM fx_runs
""",
    "o_changes": """
SELECT *, abs("count" - previous) / CAST(nullif(previous, 0) AS DOUBLE) AS change FROM o_runs
""",
    "o_closed": "SELECT * FROM fx_sales WHERE status = 'closed'",
    "o_places": """
SELECT query, lat, lng, true AS cached FROM fx_geocache
UNION ALL SELECT query, lat, lng, false FROM fx_geofound WHERE query NOT IN (SELECT query FROM fx_geocache)
""",
    "o_located": f"""
SELECT s.id, s.query, p.lat, p.lng, coalesce(p.cached, false) AS from_cache
FROM (SELECT *, {QUERY} AS query FROM fx_sales WHERE {TYPE_OK} AND {SALE_OK}) s LEFT JOIN o_places p ON p.query = s.query
""",
    "o_public": f"""
SELECT {STREET} AS street, trim(city) AS city, trunc({PRICE})::BIGINT AS price,
       '$' || format('{{:,}}', trunc({PRICE})::BIGINT) AS price_fmt, g.lat, g.lng, closing_date AS close_date
FROM (SELECT *, {QUERY} AS query FROM o_closed WHERE {TYPE_OK} AND {SALE_OK}) s JOIN fx_geocache g ON g.query = s.query
""",
    # Pages: the first card, the first image tag after it in either attribute order.
    "o_tags": r"""
SELECT *, regexp_extract(card, '(?is)<img\b[^>]*?\bsrc="(https://[^"]+)"[^>]*?\balt="([^"]*)"', 0) AS t1,
       regexp_extract(card, '(?is)<img\b[^>]*?\balt="([^"]*)"[^>]*?\bsrc="(https://[^"]+)"', 0) AS t2
FROM (SELECT *, regexp_extract(html, '(?is)<div\s+class="agent-card".*$', 0) AS card FROM (
        SELECT url, html FROM fx_profile_pages UNION ALL
        SELECT 'page ' || page_id, html FROM fx_pages))
""",
    "o_images": r"""
SELECT url, html, card, t1, t2,
       CASE WHEN t1 <> '' THEN regexp_extract(t1, '(?is)\bsrc="(https://[^"]+)"', 1)
            ELSE regexp_extract(t2, '(?is)\bsrc="(https://[^"]+)"', 1) END AS src,
       trim(replace(replace(CASE WHEN t1 <> '' THEN regexp_extract(t1, '(?is)\balt="([^"]*)"$', 1)
            ELSE regexp_extract(t2, '(?is)\balt="([^"]*)"', 1) END, '&#39;', ''''), '&amp;', '&')) AS alt
FROM o_tags
""",
    "o_scrape_rows": """
SELECT * REPLACE (CASE WHEN pos % 5 = 1 THEN photo ELSE '' END AS photo) FROM fx_asset_rows
""",
    "o_scrape_queue": """
SELECT * FROM o_scrape_rows
WHERE lower(name) = 'large rod ca'
   OR (NOT coalesce(hidden, false) AND soft_deleted_at IS NULL AND page_url <> '' AND photo = ''
       AND source NOT IN ('second', 'second_sheet'))
""",
    "o_asked": f"""
SELECT q.*, c.photo_url AS cached_photo, c.reason AS cached_reason,
       CASE WHEN c.page_url IS NULL THEN 'absent'
            WHEN NOT coalesce({iso('c.scraped_at')} > {NOW_TS} - INTERVAL 7 DAY, false) THEN 'stale'
            WHEN coalesce(c.photo_url, '') <> '' THEN 'fresh_positive' ELSE 'fresh_negative' END AS state
FROM o_scrape_queue q LEFT JOIN fx_scrape_cache c ON c.page_url = q.page_url AND q.page_url <> ''
""",
}


def fault(name: str) -> str:
    words = lambda c: f"string_split_regex(trim({c}), '\\s+')"
    quoted = lambda c: f"CASE WHEN contains({c}, '''') THEN '\"' || {c} || '\"' ELSE '''' || {c} || '''' END"
    return f"""CASE WHEN coalesce(html, '') = '' THEN 'empty_html' WHEN card = '' THEN 'no_agent_card_div'
      WHEN t1 = '' AND t2 = '' THEN 'no_img_in_agent_card'
      WHEN NOT {trusted('src')} THEN 'untrusted_host:' || src
      WHEN alt <> '' AND lower(alt) <> lower({name}) AND NOT list_has_any({words('lower(alt)')}, {words(f'lower({name})')})
      THEN 'alt_name_mismatch:expected=' || {quoted(name)} || ',got=' || {quoted('alt')} END"""


POOL["o_live"] = f"""
SELECT a.*, i.url IS NOT NULL AS got, first_value(a.pos) OVER w AS leader, i.src AS src,
       CASE WHEN i.url IS NOT NULL THEN {fault('first_value(a.name) OVER w')} END AS bad
FROM (SELECT * FROM o_asked WHERE state NOT LIKE 'fresh%') a LEFT JOIN o_images i ON i.url = a.page_url
WINDOW w AS (PARTITION BY a.page_url ORDER BY a.pos)
"""
POOL["o_scraped"] = f"""
SELECT name, page_url, id, {text(NOW_TEXT)} AS attempted_at,
       CASE WHEN state = 'fresh_positive' THEN CASE WHEN photo = '' THEN 'cached' ELSE 'cached_no_change' END
            ELSE 'cached_negative' END AS status,
       CASE WHEN state = 'fresh_positive' AND photo = '' THEN cached_photo END AS photo_url,
       CASE WHEN state = 'fresh_negative' THEN coalesce(cached_reason, 'cached_no_photo') END AS reason, pos
FROM o_asked WHERE state LIKE 'fresh%'
UNION ALL
SELECT name, page_url, id, {text(NOW_TEXT)},
       CASE WHEN NOT got THEN 'failed'
            WHEN pos = leader THEN CASE WHEN bad IS NULL THEN 'success' ELSE 'no_photo_found' END
            WHEN bad IS NOT NULL THEN 'cached_negative'
            WHEN photo = '' THEN 'cached' ELSE 'cached_no_change' END,
       CASE WHEN got AND bad IS NULL AND (pos = leader OR photo = '') THEN src END,
       CASE WHEN NOT got THEN 'fetch_failed' ELSE bad END, pos
FROM o_live
"""

DIRECTORY_ROW = f"SELECT {DIR_TEXT}, seq, pos"
EVENT_ROW = (
    "SELECT kind, name, email, array_to_string(regions, '|') AS regions, team, office, id, has_photo, soft_deleted_at, pos FROM o_events"
)
CARRIED_ROW = f"SELECT {DIR_TEXT}, seq, pos, fate, was_deleted_at FROM o_carried"
N = "CAST(count(*) AS BIGINT)"
SECTION = "CASE kind WHEN 'new' THEN 0 WHEN 'soft_delete' THEN 1 WHEN 'purge' THEN 2 ELSE 3 END"


def n_if(cond: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT)"


ROSTER_COLUMNS = (
    "id, email, first_name, last_name, name, preferred_name, role, active, region, region_alt, team, team_alt, team_name, "
    "office, office_name, phone, phone_number, title, profile_picture_url, photo_url, avatar_url, image_url, avatar_added, account"
)

ORACLES: dict[str, str] = {
    "src_roster": f"SELECT {ROSTER_COLUMNS} FROM fx_roster_a",
    "src_directory": """
WITH twice AS (SELECT * FROM o_dir UNION ALL
  SELECT * REPLACE (pos + 1000000000 AS pos, 'repeat' AS phone, upper(name) AS name) FROM o_dir WHERE pos % 7 = 0)
SELECT email, name, phone, title, team, team_logo, array_to_string(regions, '|') AS regions, office, photo, page_url, id,
       second_id, source, photo_source, photo_hash, hidden, soft_deleted_at, extras, pos
FROM (SELECT *, row_number() OVER (PARTITION BY id, second_id, source, lower(trim(name)) ORDER BY pos) AS rn FROM twice)
WHERE rn = 1
""",
    "src_transactions": f"SELECT * FROM fx_sales WHERE status = 'closed' AND closing_date BETWEEN '{YEAR}-01-01' AND '{YEAR}-12-31'",
    "src_state": "SELECT * FROM fx_geocache",
    "sink_directory": f"SELECT {DIR_TEXT} FROM o_merged",
    "sink_state": """
SELECT query, lat + CASE WHEN length(query) % 3 = 0 THEN 1 ELSE 0 END AS lat, lng FROM fx_geocache WHERE length(query) % 5 <> 0
""",
    "sink_sales": "SELECT * FROM o_public",
    "fmt_phone": f"SELECT pos, phone, {phone_of('phone')} AS pretty FROM fx_roster_a",
    "clean_title": f"SELECT pos, title, {title_of('title')} AS cleaned FROM fx_roster_a",
    "infer_region": f"SELECT pos, office, {region_of('office')} AS inferred FROM fx_roster_a",
    "name_key": f"SELECT pos, {key_of('name')} AS key FROM fx_directory",
    "slugify": f"""SELECT pos, {slug_of("' O'' ' || name || ' d’Été-- ' || email")} AS slug FROM fx_directory""",
    "strip_prefix": "SELECT pos, f0 AS given FROM o_names",
    "display_name": "SELECT pos, shown FROM o_placed",
    "first_nonblank": f"SELECT pos, team0 AS team, office0 AS office, {first_of('phone', 'phone_number')} AS phone FROM o_placed",
    "split_list": f"SELECT pos, {joined(list_of('region'))} AS regions FROM fx_roster_a",
    "parse_iso": f"SELECT pos, soft_deleted_at, epoch_us({iso('soft_deleted_at')}) AS micros FROM fx_directory",
    "url_hash": "SELECT pos, photo, CASE WHEN photo = '' THEN '' ELSE sha256(photo) END AS hash FROM fx_directory",
    "entity_key": f"SELECT pos, {ASSET_KEY} AS key FROM fx_asset_rows",
    "valid_url": f"SELECT pos, CASE WHEN regexp_matches({PHOTO}, '^https?://') THEN {PHOTO} ELSE '' END AS photo FROM fx_roster_a",
    "strip_house_no": f"SELECT id, {STREET.replace('trim(address)', 'address')} AS street FROM fx_sales",
    "fmt_price": f"SELECT id, '$' || format('{{:,}}', trunc({PRICE})::BIGINT) AS price_fmt FROM fx_sales",
    "addr_query": f"SELECT id, {QUERY} AS query FROM fx_sales",
    "host_class": f"""
SELECT pos, CASE WHEN photo = '' THEN 'blank' WHEN {hosted('photo')} THEN 'self_hosted' WHEN {trusted('photo')} THEN 'trusted'
       ELSE 'unknown' END AS kind FROM fx_directory
""",
    "rebase_url": rf"""
SELECT pos, CASE WHEN regexp_extract(photo, '/photos/([^/]+)\.jpg', 1) IN (SELECT key FROM fx_assets)
  THEN {text(ASSET.public_base + '/')} || regexp_extract(photo, '/photos/([^/]+)\.jpg', 1) || '.jpg' ELSE photo END AS photo
FROM fx_asset_rows
""",
    "lookup_default": "SELECT pos, r.team, coalesce(l.logo, '') AS team_logo FROM fx_roster_a r LEFT JOIN o_logos l ON l.team = r.team",
    "in_list_ci": f"""
SELECT pos, {ROLE_OK} AS allowed, lower(trim(team)) IN {texts(v.lower() for v in SYNC.hide_team_names)} AS hidden_team FROM fx_roster_a
""",
    "assign_region": f"SELECT pos, {joined(ASSIGNED)} AS regions FROM o_filled",
    "parse_roster": f"SELECT * REPLACE ({joined('regions')} AS regions) FROM o_parsed",
    "suppress_ids": f"""
SELECT pos, CASE WHEN id IN {texts(SYNC.suppressed_ids)} THEN 'audit' ELSE 'kept' END AS side FROM fx_roster_a WHERE trim(email) <> ''
""",
    "drop_inactive": "SELECT pos, active FROM fx_roster_a WHERE active IS DISTINCT FROM false",
    "role_gate": f"SELECT pos, CASE WHEN trim(role) = '' OR {ROLE_OK} THEN '' ELSE trim(role) END AS role FROM fx_roster_a",
    "hide_team": f"""
SELECT pos, CASE WHEN lower(trim(team)) IN {texts(v.lower() for v in SYNC.hide_team_names)} OR id IN {texts(SYNC.hide_team_ids)}
  THEN '' ELSE team END AS team FROM fx_roster_a
""",
    "junk_rules": f"""
SELECT pos, email, name, coalesce({junk_cases()}, '') AS reason
FROM (SELECT pos, lower(trim(email)) AS email, first_name || ' ' || last_name AS name FROM fx_roster_a)
""",
    "no_region": "SELECT pos, CASE WHEN len(regions) = 0 THEN 'audit' ELSE 'kept' END AS side FROM o_parsed",
    "missing_data": """
SELECT name, email, id, office, array_to_string(regions, '|') AS regions, team, 'MISSING_DATA' AS flag, missing AS reason,
       'Shown on site. Update the profile in the source system.' AS action, pos FROM o_valid WHERE missing <> ''
""",
    "dup_names": """
SELECT name, email, 'POTENTIAL_DUPLICATE' AS flag, reason,
       'Verify these are different people or merge/deactivate in the source system.' AS action, pos FROM o_dup_flags
""",
    "dup_members": "SELECT pos, email, nk AS name_key, n FROM o_dups WHERE n > 1 AND nk <> ''",
    "flag_union": "SELECT * FROM o_flags",
    "safety_gate": f"""
WITH c AS (SELECT (SELECT count(*) FROM o_valid) AS v, (SELECT count(*) FROM o_dir) AS p,
  (SELECT count(*) FROM o_dir WHERE NOT list_contains(regions, {text(SYNC.second_region)}) AND source <> 'sheet') AS m)
SELECT v AS valid_rows, p AS previous_rows, m AS previous_main_rows, v / CAST(m AS DOUBLE) AS share,
       CASE WHEN v = 0 THEN 'no valid rows after filtering' WHEN v < 50 THEN 'fewer valid rows than the minimum'
            WHEN v / CAST(m AS DOUBLE) < 0.5 THEN 'too few valid rows against the previous directory' ELSE '' END AS refused,
       v >= 50 AND v / CAST(m AS DOUBLE) >= 0.5 AS publish FROM c
""",
    "sales_type": f"SELECT * FROM fx_sales WHERE {TYPE_OK}",
    "sales_valid": f"SELECT * FROM fx_sales WHERE {SALE_OK}",
    "scrape_eligible": """
SELECT pos, reason, reason = 'eligible' AS eligible FROM (
  SELECT pos, CASE WHEN hidden THEN 'hidden' WHEN coalesce(soft_deleted_at, '') <> '' THEN 'soft_deleted'
    WHEN page_url = '' THEN 'no_profile_url' WHEN photo <> '' THEN 'has_photo'
    WHEN source IN ('second', 'second_sheet') THEN 'second_account_excluded' ELSE 'eligible' END AS reason FROM fx_directory)
""",
    "asset_decision": "SELECT pos, key, stored, reason, needs FROM o_needs",
    "asset_pending": f"""
SELECT pos, starts_with(photo, {text(ASSET.optimise_prefix)}) AS bulk,
  starts_with(photo, {text(ASSET.optimise_prefix)}) AND NOT (
    EXISTS (SELECT 1 FROM fx_asset_cache c WHERE c.source_url = r.photo AND c.id = r.id) AND r.id IN (SELECT key FROM fx_assets)) AS pending
FROM fx_asset_rows r
""",
    "force_limit": """
SELECT pos, key, CASE WHEN pos = 13 THEN 'forced' ELSE reason END AS reason FROM o_needs
WHERE key IS NOT NULL AND (needs OR pos = 13) ORDER BY pos LIMIT 40
""",
    "cross_account_dedup": """
SELECT pos, CASE WHEN id <> '' AND id IN (SELECT id FROM fx_roster_a) THEN 'id'
  WHEN trim(email) <> '' AND lower(trim(email)) IN (SELECT lower(trim(email)) FROM fx_roster_a) THEN 'email' ELSE 'kept' END AS cause
FROM fx_roster_b
""",
    "match_index": """
SELECT key, row_id, 'email' AS kind FROM o_email_idx UNION ALL SELECT key, row_id, 'id' FROM o_id_idx
UNION ALL SELECT key, row_id, 'name' FROM o_name_idx
""",
    "manual_pairs": "SELECT * FROM o_manual",
    "tiered_match": "SELECT in_pos, row_id, CAST(tier AS BIGINT) AS tier FROM o_matches",
    "unmatched": "SELECT pos, email, name FROM o_gone",
    "region_unmatched": "SELECT name, email, team, array_to_string(regions, '|') AS regions, source, pos FROM o_gone WHERE regional",
    "url_check_lookup": f"""
SELECT d.pos, d.slug_wanted,
  CASE WHEN c.status BETWEEN 200 AND 299 THEN 'live'
       WHEN {iso('c.checked_at')} > {NOW_TS} - INTERVAL {SYNC.url_recheck_seconds} SECOND THEN 'cooldown' ELSE 'recheck' END AS "check",
  CASE WHEN c.status BETWEEN 200 AND 299 THEN c.url ELSE '' END AS checked_url
FROM (SELECT pos, {slug_of('name')} AS slug_wanted FROM fx_directory) d LEFT JOIN fx_url_checks c ON c.slug = d.slug_wanted
""",
    "scrape_cache_lookup": f"""
SELECT r.pos, r.page_url, c.photo_url AS cached_photo, c.reason AS cached_reason,
  CASE WHEN c.page_url IS NULL THEN 'absent'
       WHEN NOT coalesce({iso('c.scraped_at')} > {NOW_TS} - INTERVAL 7 DAY, false) THEN 'stale'
       WHEN coalesce(c.photo_url, '') <> '' THEN 'fresh_positive' ELSE 'fresh_negative' END AS cache_state
FROM fx_asset_rows r LEFT JOIN fx_scrape_cache c ON c.page_url = r.page_url
""",
    "geocode_lookup": "SELECT * FROM o_located",
    "geocode_misses": "SELECT DISTINCT query FROM o_located WHERE lat IS NULL OR lng IS NULL",
    "retry_cooldown": f"""
SELECT pos, k AS key, coalesce({RUN} - r.last_run > 0 AND ({RUN} - r.last_run) % 2 = 1, false) AS cooldown
FROM (SELECT pos, {ASSET_KEY} AS k FROM fx_asset_rows) a LEFT JOIN fx_retries r ON r.key = a.k
""",
    "orphan_assets": f"SELECT key FROM fx_assets WHERE key NOT IN (SELECT {ASSET_KEY} FROM fx_asset_rows WHERE {ASSET_KEY} IS NOT NULL)",
    "field_merge": f"SELECT {DIR_TEXT}, CAST(seq AS BIGINT) AS seq, pos, fate, was_deleted_at FROM o_fields",
    "region_pin": "SELECT pos, team, team_logo, office, title, array_to_string(regions, '|') AS regions, extras FROM o_pinned",
    "photo_seed": "SELECT pos, photo FROM o_fields",
    "logo_rule": "SELECT pos, team, team_logo FROM o_fields",
    "visibility": "SELECT pos, hidden FROM o_fields",
    "source_rule": "SELECT pos, source FROM o_fields",
    "new_rows": EVENT_ROW + " WHERE kind = 'new'",
    "reactivated": EVENT_ROW + " WHERE kind = 'reactivated'",
    "soft_delete": CARRIED_ROW + " WHERE fate = 'soft_delete'",
    "grace_keep": CARRIED_ROW + " WHERE fate = 'grace'",
    "purge": CARRIED_ROW + " WHERE fate = 'purge'",
    "joint_keep": CARRIED_ROW + " WHERE fate = 'joint'",
    "region_keep": f"""
SELECT {DIR_TEXT}, CAST(1 AS BIGINT) AS seq, pos, 'kept' AS fate, nullif(soft_deleted_at, '') AS was_deleted_at FROM o_gone WHERE regional
""",
    "page_url_assign": "SELECT pos, name, page_url FROM o_paged",
    "page_url_checks": f"""
SELECT {N} AS assigned, {n_if('c.status IS NULL OR c.status NOT BETWEEN 200 AND 299')} AS unconfirmed
FROM (SELECT {slug_of('name')} AS slug FROM o_paged WHERE wants) p LEFT JOIN fx_url_checks c ON c.slug = p.slug
""",
    "directory_merge": f"{DIRECTORY_ROW}, incoming_photo, incoming_photo_real FROM o_full",
    "asset_cascade": "SELECT * FROM o_asset_events",
    "asset_apply": f"""
SELECT r.pos, CASE WHEN e.key IS NOT NULL THEN {text(ASSET.public_base + '/')} || e.key || '.jpg' ELSE photo END AS photo,
  coalesce(e.source, r.photo_source) AS photo_source, coalesce(sha256(e.source_url), r.photo_hash) AS photo_hash
FROM fx_asset_rows r LEFT JOIN (SELECT * FROM o_asset_events WHERE status = 'success') e ON e.pos = r.pos
""",
    "retry_update": f"""
WITH ev AS (SELECT key, pos, recorded, retry_reason FROM o_asset_events WHERE recorded IS NOT NULL),
ok AS (SELECT key, max(pos) AS last_ok FROM ev WHERE recorded GROUP BY key),
bad AS (SELECT ev.key, count(*) AS n, arg_max(retry_reason, pos) AS why FROM ev LEFT JOIN ok ON ok.key = ev.key
        WHERE NOT recorded AND (last_ok IS NULL OR pos > last_ok) GROUP BY ev.key),
old AS (SELECT * FROM fx_retries WHERE key NOT IN (SELECT key FROM ok))
SELECT coalesce(old.key, bad.key) AS key, CAST(CASE WHEN n IS NOT NULL THEN {RUN} ELSE last_run END AS BIGINT) AS last_run,
  CASE WHEN n IS NOT NULL THEN {text(NOW_TEXT)} ELSE last_at END AS last_at,
  CASE WHEN n IS NOT NULL THEN why ELSE last_reason END AS last_reason,
  CAST(coalesce(failure_count, 0) + coalesce(n, 0) AS BIGINT) AS failure_count
FROM old FULL OUTER JOIN bad ON bad.key = old.key
""",
    "cache_upsert": """
SELECT * FROM fx_geofound WHERE lat IS NOT NULL UNION ALL
SELECT * FROM fx_geocache WHERE query NOT IN (SELECT query FROM fx_geofound WHERE lat IS NOT NULL)
""",
    "cache_upsert_scrape": """
WITH new AS (SELECT page_url, photo_url, attempted_at AS scraped_at, name AS agent_name, reason FROM o_scraped
             WHERE status IN ('success', 'no_photo_found'))
SELECT * FROM new UNION ALL SELECT * FROM fx_scrape_cache WHERE page_url NOT IN (SELECT page_url FROM new)
""",
    "cache_upsert_url_check": f"""
SELECT slug, CAST(CASE WHEN status = 404 THEN 200 ELSE status END AS BIGINT) AS status,
  CASE WHEN status = 404 THEN 'https://pages.example.com/' || slug ELSE url END AS url,
  CASE WHEN status = 404 THEN {text(NOW_TEXT)} ELSE checked_at END AS checked_at FROM fx_url_checks
""",
    "sales_public": "SELECT * FROM o_public",
    "sync_summary": f"""
WITH f AS (SELECT {n_if("flag = 'JUNK_ACCOUNT'")} AS junk, {n_if("flag = 'NO_REGION'")} AS bare,
  {n_if("flag = 'MISSING_DATA'")} AS miss, {n_if("flag = 'POTENTIAL_DUPLICATE'")} AS dup FROM o_flags),
l AS (SELECT {n_if("fate <> 'purge'")} AS inside, {n_if("fate <> 'purge' AND coalesce(hidden, false)")} AS hid,
  {n_if("fate = 'new'")} AS nw, {n_if("fate = 'soft_delete'")} AS sd, {n_if("fate = 'purge'")} AS pu,
  {n_if("fate = 'reactivated'")} AS re FROM o_ledger)
SELECT inside + junk + bare AS total_considered, inside - hid AS live_on_site, hid AS hidden_on_site, bare AS excluded_no_region,
  junk AS excluded_junk, miss AS missing_data, dup AS potential_duplicates, inside AS included_in_site, bare AS missing_region,
  nw AS new_rows, sd AS soft_deletes, pu AS purges, re AS reactivated FROM f, l
""",
    "role_counts": f"SELECT role, {N} AS n FROM o_clean WHERE dropped = 'role' GROUP BY role",
    "skip_counts": f"SELECT CASE WHEN needs THEN 'no_key' ELSE reason END AS reason, {N} AS n FROM o_needs WHERE NOT needs OR key IS NULL GROUP BY 1",
    "asset_summary": f"""
SELECT {N} AS total_events, {n_if("source = 'source_a'")} AS acquired_a, {n_if("source = 'source_b'")} AS acquired_b,
  {n_if("status IN ('kept_existing', 'kept_existing_source_a')")} AS kept_existing, {n_if("status LIKE 'failed%'")} AS failed,
  {n_if("status = 'source_b_cooldown'")} AS cooldown FROM o_asset_events
""",
    "scrape_summary": f"""
SELECT {N} AS total_attempted, {n_if("status = 'success'")} AS successful, {n_if("status = 'cached'")} AS cached,
  {n_if("status = 'failed'")} AS failed, {n_if("status = 'no_photo_found'")} AS not_found,
  {n_if("status = 'cached_negative'")} AS cached_negative FROM o_scraped
""",
    "geocode_summary": f"""
SELECT {n_if('lat IS NOT NULL')} AS located, {n_if('lat IS NOT NULL AND from_cache')} AS from_cache,
  {n_if('lat IS NOT NULL AND NOT from_cache')} AS new_lookups, {n_if('lat IS NULL')} AS failed FROM o_located
""",
    "coverage_stats": f"""
SELECT {N} AS total, {n_if('NOT coalesce(hidden, false)')} AS visible,
  {n_if("NOT coalesce(hidden, false) AND coalesce(photo, '') <> ''")} AS with_photo,
  {n_if('NOT coalesce(hidden, false) AND len(regions) > 0')} AS with_region,
  {n_if('NOT coalesce(hidden, false) AND len(regions) = 0')} AS without_region FROM o_merged
""",
    "sales_funnel": f"""
SELECT CAST(1 AS BIGINT) AS step_no, 'closed' AS step, {N} AS n FROM o_closed
UNION ALL SELECT 2, 'residential', {n_if(TYPE_OK)} FROM o_closed
UNION ALL SELECT 3, 'valid', {n_if(f'{TYPE_OK} AND {SALE_OK}')} FROM o_closed
UNION ALL SELECT 4, 'located', (SELECT count(*) FROM o_public)
""",
    "sort_name": "SELECT name, email, pos FROM o_merged",
    "sort_name_photo_first": "SELECT name, photo, pos FROM o_merged",
    "sort_role": "SELECT name, email, role, id, pos FROM o_clean WHERE dropped = 'role'",
    "retain_n": """
SELECT series, run_id, row_number() OVER (PARTITION BY series ORDER BY ts DESC) <= 30 AS keep FROM fx_snapshots
""",
    "first_of_day": "SELECT run_id, first_of_day FROM o_runs",
    "change_reason": """
SELECT run_id, "count", coalesce(previous, -1) AS previous, CASE WHEN first_of_day THEN 'first sync of the day (UTC)'
  WHEN previous > 0 AND "count" <> previous THEN 'count changed: ' || previous || ' → ' || "count" || ' (' || printf('%.1f%%', change * 100) || ')'
  ELSE 'routine sync (every backup committed for safety)' END AS reason, true AS keep_copy FROM o_changes
""",
    "change_reason_threshold": """
SELECT run_id, "count", coalesce(previous, -1) AS previous, CASE WHEN first_of_day THEN 'first sync of the day (UTC)'
  WHEN previous > 0 AND change >= 0.05 THEN 'significant change: ' || printf('%.0f%%', change * 100) || ' (threshold: 5%)'
  WHEN previous > 0 THEN 'routine sync, ' || printf('%.1f%%', change * 100) || ' change (under 5% threshold)'
  ELSE '' END AS reason, first_of_day OR (previous > 0 AND change >= 0.05) AS keep_copy FROM o_changes
""",
    "preview_k": """
WITH b AS (SELECT *, row_number() OVER (ORDER BY pos) AS rn, count(*) OVER () AS n FROM o_flags WHERE flag = 'NO_REGION')
SELECT rn AS rank, name, email, -1 AS remaining FROM b WHERE rn <= 10
UNION ALL SELECT 11, '', '', n - 10 FROM b WHERE rn = 11
""",
    "distinct_reasons": """
SELECT reason, min(pos) AS pos, arg_min(name, pos) AS name FROM o_dup_flags GROUP BY reason
""",
    "rpt_live": """
SELECT name, email, array_to_string(regions, '|') AS regions, coalesce(team, '') AS team, coalesce(office, '') AS office,
  coalesce(phone, '') AS phone, coalesce(photo, '') <> '' AS has_photo, coalesce(page_url, '') <> '' AS has_profile,
  coalesce(hidden, false) AS hidden, coalesce(source, '') AS source, coalesce(id, '') AS id, coalesce(second_id, '') AS second_id
FROM o_merged
""",
    "rpt_no_region": "SELECT * FROM o_flags WHERE flag = 'NO_REGION'",
    "rpt_role_excluded": "SELECT name, email, role, id, pos FROM o_clean WHERE dropped = 'role'",
    "rpt_region_unmatched": "SELECT name, email, team, array_to_string(regions, '|') AS regions, source FROM o_gone WHERE regional",
    "rpt_no_photo": """
SELECT name, email, array_to_string(regions, '|') AS regions, team, source, id, second_id FROM o_merged
WHERE coalesce(photo, '') = '' AND NOT coalesce(hidden, false)
""",
    "rpt_no_page": f"""
SELECT name, email, array_to_string(regions, '|') AS regions, team, source, id, second_id, {slug_of('name')} AS suggested_slug,
  {text(SYNC.page_base + '/')} || {slug_of('name')} AS suggested_url FROM o_dir
WHERE page_url = '' AND NOT coalesce(hidden, false) AND NOT list_contains(regions, {text(SYNC.second_region)})
  AND source NOT IN ('sheet', 'second')
""",
    "rpt_flagged": "SELECT * FROM o_flags WHERE flag <> 'NO_REGION'",
    "rpt_events": EVENT_ROW,
    "event_digest": f"""
WITH s AS (SELECT kind, {SECTION} AS o, count(*) AS n FROM o_events GROUP BY 1, 2),
h AS (SELECT *, coalesce(sum(n + 2) OVER (ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS top FROM s),
e AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY pos) AS rn,
  coalesce(nullif(team, ''), 'Solo agent') || ' · ' || coalesce(nullif(array_to_string(regions, ', '), ''), 'No region') AS place FROM o_events)
SELECT CAST(top + 1 AS BIGINT) AS line_no, '' AS line FROM h
UNION ALL SELECT top + 2, n || CASE o WHEN 0 THEN ' new agent(s) added:'
  WHEN 1 THEN ' agent(s) soft-deleted (gone from the source, hidden on site, 30-day grace before purge):'
  WHEN 2 THEN ' agent(s) purged (gone for 30+ days):' ELSE ' agent(s) reactivated (reappeared in the source):' END FROM h
UNION ALL SELECT top + 2 + rn, CASE o
  WHEN 0 THEN '  + ' || name || ' <' || email || '> · ' || place || CASE WHEN has_photo THEN '' ELSE ' [no photo yet]' END
  WHEN 1 THEN '  - ' || name || ' <' || email || '> · ' || place
  WHEN 2 THEN '  ✗ ' || name || ' <' || email || '> (soft-deleted ' || soft_deleted_at || ')'
  ELSE '  ↻ ' || name || ' <' || email || '>' END FROM e JOIN h ON h.kind = e.kind
""",
    "page_extract": f"""
SELECT page_id, name, CASE WHEN bad IS NULL THEN src END AS photo_url, bad AS reason FROM (
  SELECT p.page_id, p.name, i.src, {fault('p.name')} AS bad FROM (SELECT page_id, name FROM fx_pages) p
  JOIN o_images i ON i.url = 'page ' || p.page_id)
""",
    "page_extract_profiles": f"""
SELECT url, name, CASE WHEN bad IS NULL THEN src END AS photo_url, bad AS reason FROM (
  SELECT i.url, b.name, i.src, {fault('b.name')} AS bad
  FROM (SELECT 'https://pages.example.com/p/' || ks AS url, p_name || ' ' || lk AS name FROM fx_base) b
  JOIN o_images i ON i.url = b.url)
""",
    "scrape_apply": "SELECT * FROM o_scraped",
    "stream_event_counts": f"""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, kind, {N} AS n FROM fx_lifecycle GROUP BY 1, 2
""",
}
ORACLES["rpt_no_page_merged"] = ORACLES["rpt_no_page"].replace("FROM o_dir", "FROM o_merged")

# Each report of a run: its description and the SQL of its rows.
_REPORTS = {
    "summary": ("Counts of the run.", "SELECT 1"),
    "live": ("All rows of the directory.", ORACLES["rpt_live"]),
    "no-region": ("Rows excluded for want of a region.", ORACLES["rpt_no_region"]),
    "role-excluded": ("Rows excluded for their role.", ORACLES["rpt_role_excluded"]),
    "role-counts": ("Excluded rows per role.", f"SELECT DISTINCT role FROM ({ORACLES['rpt_role_excluded']})"),
    "region-unmatched": ("Rows of the second region nobody matched.", ORACLES["rpt_region_unmatched"]),
    "no-photo": ("Visible rows without a photo.", ORACLES["rpt_no_photo"]),
    "no-page": ("Visible rows of the main region without a page.", ORACLES["rpt_no_page_merged"]),
    "flagged": ("Junk, duplicate and incomplete rows.", ORACLES["rpt_flagged"]),
    "events": ("New, soft-deleted, purged and returned rows.", "SELECT kind FROM o_events"),
}
ORACLES["sink_reports"] = " UNION ALL ".join(
    f"SELECT {text(name)} AS report, {text(NOW_TEXT)} AS generated, false AS dry_run, {text(about)} AS description, (SELECT count(*) FROM ({rows})) AS count"
    for name, (about, rows) in _REPORTS.items()
)


def _values(pairs) -> str:
    return ", ".join(f"({n if isinstance(n, int) else text(n)}, {text(t)})" for n, t in pairs)


_NUMBER = "CASE WHEN length(sig) > 8 THEN 1114112 WHEN lower(substr(ref, 2, 1)) = 'x' THEN ('0x0' || sig)::BIGINT ELSE ('0' || sig)::BIGINT END"
ORACLES["html_text"] = rf"""
WITH e AS (SELECT name, t AS value FROM (VALUES {_values(entity_names().items())}) v(name, t)),
g AS (SELECT n, t AS value FROM (VALUES {_values(code_page_texts().items())}) v(n, t)),
s AS (SELECT page_id, string_split(html, '&') AS parts FROM pages),
p AS (SELECT page_id, i, parts[i] AS part, CASE WHEN i > 1 THEN regexp_extract(parts[i], '{REFERENCE}', 1) ELSE '' END AS ref
  FROM (SELECT page_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM s)),
m AS (SELECT page_id, i, arg_max(name, length(name)) AS name, arg_max(value, length(name)) AS value
  FROM p JOIN e ON substr(p.ref, 1, 2) = substr(e.name, 1, 2) AND starts_with(p.ref, e.name) GROUP BY page_id, i),
c AS (SELECT *, {_NUMBER} AS code FROM (SELECT page_id, i, ref, ltrim(regexp_extract(ref, '^#[xX]?([0-9a-fA-F]+)', 1), '0') AS sig FROM p WHERE ref LIKE '#%')),
d AS (SELECT page_id, i, CASE WHEN code = 0 OR code BETWEEN 55296 AND 57343 OR code > 1114111 THEN chr(65533) WHEN g.value IS NOT NULL THEN g.value
  WHEN code BETWEEN 1 AND 8 OR code = 11 OR code BETWEEN 14 AND 31 OR code = 127 OR code BETWEEN 64976 AND 65007 OR code % 65536 >= 65534 THEN ''
  ELSE chr(code::INT) END AS value FROM c LEFT JOIN g ON c.code = g.n),
t AS (SELECT p.page_id, p.i, CASE WHEN p.i = 1 THEN part WHEN d.value IS NOT NULL THEN d.value || substr(part, length(ref) + 1)
  WHEN m.name IS NOT NULL THEN m.value || substr(part, length(m.name) + 1) ELSE '&' || part END AS t
  FROM p LEFT JOIN m ON p.page_id = m.page_id AND p.i = m.i LEFT JOIN d ON p.page_id = d.page_id AND p.i = d.i),
w AS (SELECT page_id, string_agg(t, '' ORDER BY i) AS t FROM t GROUP BY page_id)
SELECT page_id, length(t) AS n_chars, sha256(t) AS text_sha256 FROM pages LEFT JOIN w USING (page_id)
"""
POOL["o_full"] = """
SELECT l.*, i.incoming_photo, i.incoming_photo_real FROM o_merged l
LEFT JOIN o_valid i ON l.seq = 0 AND i.pos = l.pos
"""


def _chained(snapshots: int, days: int) -> None:
    """Views of syncs that follow each other: each merges its own snapshot into what the one before published."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for other in parents(POOL[name], POOL):
            if other.startswith("o_") and other not in (*needed, "o_dir"):
                visit(other)
        needed.append(name)

    visit("o_merged")
    order = "soft_deleted_at, extras, row_number() OVER (ORDER BY lower(coalesce(name, '')), seq, pos) AS pos"
    for n in range(snapshots):
        POOL[f"r{n}_main"] = f"SELECT * FROM fx_roster_a WHERE account = 'main' AND pos % 50 <> {n}"
        POOL[f"r{n}_roster"] = f"""
SELECT * FROM r{n}_main UNION ALL
SELECT * REPLACE (pos + {ACCOUNT_SPAN} AS pos) FROM fx_roster_a WHERE account <> 'main' AND pos % 50 <> {n}
  AND NOT coalesce(trim(id) <> '' AND trim(id) IN (SELECT trim(id) FROM r{n}_main WHERE id IS NOT NULL), false)
  AND NOT coalesce(trim(email) <> '' AND lower(trim(email)) IN (SELECT lower(trim(email)) FROM r{n}_main WHERE email IS NOT NULL), false)
"""
        before = "o_dir" if n == 0 else f"(SELECT {MERGED_COLUMNS}, {order} FROM r{n - 1}_merged)"
        POOL[f"r{n}_dir"] = f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY coalesce(id, ''), coalesce(second_id, ''), coalesce(source, ''), lower(trim(coalesce(name, ''))) ORDER BY pos) AS rn FROM {before})
WHERE rn = 1
"""
        now = (NOW + timedelta(days=days * n)).isoformat()
        for name in needed:
            body = re.sub(r"\bo_(\w+)", lambda m: f"r{n}_{m[1]}" if m[0] in needed or m[0] == "o_dir" else m[0], POOL[name])
            POOL[f"r{n}_{name[2:]}"] = body.replace("fx_roster_a", f"r{n}_roster").replace(NOW_TEXT, now)


MERGED_COLUMNS = (
    "email, name, phone, title, team, team_logo, regions, office, photo, page_url, id, second_id, source, photo_source, photo_hash, hidden"
)
_chained(3, 20)
ORACLES["stream_snapshots"] = f"SELECT {DIR_TEXT} FROM r2_merged"


def oracle_texts() -> dict[str, str]:
    out = {}
    for key, sql in ORACLES.items():
        sql = sql.strip()
        if sql.upper().startswith("WITH"):
            head = with_clause(POOL, sql)
            # A text with a WITH of its own: join the two clauses.
            needed = head[: head.rindex(sql)].strip()
            out[key] = duck_sql(needed + ",\n" + sql[4:].lstrip()) if needed else duck_sql(sql)
        else:
            out[key] = duck_sql(with_clause(POOL, sql))
    return out
