"""Schemas of the engine's tables, as DDL. Missing strings are '', not null."""

DATES = "dates MAP<STRING,STRING>, extra MAP<STRING,STRING>"
RECORD = (
    "authority STRING, qa_id STRING, slug STRING, family STRING, joint_id STRING, legal_act STRING, legal_act_ref STRING, legal_act_raw STRING, "
    f"article STRING, topic STRING, status STRING, {DATES}, source_url STRING, retrieved_at STRING, question STRING, background STRING, answer STRING, content_hash STRING"
)
REGISTER_ROW = (
    "joint_id STRING, authority STRING, native_id STRING, link STRING, status STRING, legal_act_raw STRING, article STRING, topic STRING, "
    "answered_by STRING, date_submission STRING, date_publication STRING, link_alts ARRAY<STRING>"
)
STATE = "key STRING, hash STRING, verified_at STRING"
META = "last_full_sweep STRING"
COUNTERS = ("enumerated", "seen", "written", "checked", "archived", "delisted", "errors")
RUN = (
    "ts STRING, mode STRING, authorities ARRAY<STRING>, full BOOLEAN, state_sha256 STRING, totals MAP<STRING,STRUCT<"
    + ",".join(f"{c}:BIGINT" for c in COUNTERS)
    + ">>"
)
INDEX_ROW = (
    "authority STRING, qa_id STRING, joint_id STRING, legal_act STRING, article STRING, topic STRING, status STRING, date STRING, delisted STRING, "
    "archived STRING, mirrored STRING, source_url STRING, file STRING, question STRING, background STRING, answer STRING"
)
