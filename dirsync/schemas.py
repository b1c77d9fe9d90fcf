"""Schemas of the tables, and the field names used in JSON files."""

from __future__ import annotations

from pyspark.sql import types as T


STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Raw roster fields: table column -> accepted JSON spellings (exact case).
ROSTER_FIELDS: dict[str, tuple[str, ...]] = {
    "id": ("id",),
    "email": ("email",),
    "first_name": ("first_name",),
    "last_name": ("last_name",),
    "name": ("name",),
    "preferred_name": ("Preferred Name",),
    "role": ("role",),
    "active": ("active",),
    "region": ("region",),
    "region_alt": ("Region",),
    "team": ("team",),
    "team_alt": ("Team",),
    "team_name": ("team_name",),
    "office": ("office",),
    "office_name": ("office_name",),
    "phone": ("phone",),
    "phone_number": ("phone_number",),
    "title": ("title",),
    "profile_picture_url": ("profile_picture_url",),
    "photo_url": ("photo_url",),
    "avatar_url": ("avatar_url",),
    "image_url": ("image_url",),
    "avatar_added": ("avatar_added",),
}
ROSTER_FLAGS = ("active", "avatar_added")

# Directory fields: table column -> JSON name.
DIRECTORY_FIELDS: dict[str, str] = {
    "email": "email",
    "name": "name",
    "phone": "phone",
    "title": "title",
    "team": "team",
    "team_logo": "teamLogo",
    "regions": "regions",
    "office": "office",
    "photo": "photo",
    "page_url": "profileUrl",
    "id": "id",
    "second_id": "secondId",
    "source": "source",
    "photo_source": "photoSource",
    "photo_hash": "photoSourceHash",
    "hidden": "hidden",
    "soft_deleted_at": "softDeletedAt",
}
DIRECTORY_COLUMNS = [*DIRECTORY_FIELDS, "extras"]
# Columns that live only between the sync and the photo job.
TEMPORARY_COLUMNS = ["incoming_photo", "incoming_photo_real"]

DIRECTORY = _struct(
    **{c: STRING for c in DIRECTORY_FIELDS} | {"regions": T.ArrayType(STRING), "hidden": T.BooleanType()},
    extras=T.MapType(STRING, STRING),
    pos=LONG,
)

TRANSACTIONS = _struct(
    id=LONG,
    status=STRING,
    transaction_type=STRING,
    price=DOUBLE,
    sales_volume=DOUBLE,
    address=STRING,
    city=STRING,
    state=STRING,
    zip=STRING,
    closing_date=STRING,
)

# Keyed state tables.
URL_CHECKS = _struct(slug=STRING, status=T.IntegerType(), url=STRING, checked_at=STRING)
SCRAPE_CACHE = _struct(page_url=STRING, photo_url=STRING, scraped_at=STRING, agent_name=STRING, reason=STRING)
ASSET_RETRIES = _struct(key=STRING, last_run=LONG, last_at=STRING, last_reason=STRING, failure_count=LONG)
ASSET_CACHE = _struct(
    source_url=STRING, id=STRING, optimized_size=LONG, source_size=LONG, processed_at=STRING, output_path=STRING
)
GEOCODE_CACHE = _struct(query=STRING, lat=DOUBLE, lng=DOUBLE)
