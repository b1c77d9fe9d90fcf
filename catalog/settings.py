"""Invented rule tables used by the registered queries."""

from datetime import datetime, timezone

from dirsync import AssetConfig, SalesConfig, SyncConfig

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)
RUN = 100
YEAR = 1998

SYNC = SyncConfig(
    second_region="ASIA",
    office_regions=(
        ("nation_11", "AMERICA"),
        ("nation_1", "AFRICA"),
        ("nation_2", "ASIA"),
        ("nation_3", "EUROPE"),
    ),
    team_logos={f"Team {i}": f"https://logos.example.com/team-{i}.png" for i in range(8)} | {"Team 9": ""},
    hide_team_names=("Team 5",),
    hide_team_ids=tuple(str(k) for k in range(21, 2000, 300)),
    suppressed_ids=tuple(str(k) for k in range(19, 2000, 100)),
    junk_email_patterns=(r"test", r"\bsample\b", r"00000"),
    junk_name_patterns=(r"cold anvil", r"^hot ring\b"),
    staff_email_patterns=(r"u\d*99@example", r"admin@house"),
    house_domain="@house.example.com",
    manual_pairs={
        str(k): "former " + str(k).translate(str.maketrans("0123456789", "abcdefghij"))
        for k in range(8, 15000, 200)
    },
    joint_emails=tuple(f"u{k}@example.com" for k in range(29, 2000, 50)),
)
ASSET = AssetConfig()
SALES = SalesConfig()
