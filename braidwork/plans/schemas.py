"""Schemas of the stored tables, and the check that a frame fits one before it is written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AI_PAYLOADS = "key_id string not null, method string not null, payload string not null, created_at timestamp not null"
HUMAN_PAYLOADS = "key_id string not null, method string not null, payload string not null, case_id string, created_at timestamp not null"
PENDING = (
    "image_id string, key_id string not null, segment string not null, case_id string, pending_type string not null, payload string not null, "
    "created_at timestamp, first_seen_at timestamp, last_retried_at timestamp, retry_count bigint not null, matched_ai_keys string, "
    "next_ai_iteration bigint not null, merged_case_ids string, last_compared_signature string, comparison_version bigint not null"
)
AI_PENDING = (
    "image_id string, key_id string not null, segment string not null, payload string not null, created_at timestamp, "
    "first_seen_at timestamp, last_retried_at timestamp, retry_count bigint not null"
)
RESULTS = (
    "image_id string not null, key_id string not null, segment string not null, case_id string, ai_iteration int not null, ai_created_at timestamp, "
    "human_created_at timestamp, field_name string not null, array_key string, segment_type string, human_value string, ai_value string, "
    "is_match boolean not null, load_time timestamp not null"
)
DEAD_LETTERS = (
    "image_id string not null, key_id string, segment string not null, case_id string, pending_type string not null, payload string, "
    "created_at timestamp, first_seen_at timestamp, aged_out_at timestamp not null, reason string"
)
#: Schema of each stored table, and the partitions that its writer makes.
TABLES = {
    "ai_payloads": (AI_PAYLOADS, "day date"), "human_payloads": (HUMAN_PAYLOADS, "day date"), "pending_comparisons": (PENDING, "v string"),
    "ai_pending_comparisons": (AI_PENDING, "v string"), "comparison_results": (RESULTS, "run string, day date"), "dead_letter_comparisons": (DEAD_LETTERS, "run string, day date"),
}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def fitted(df: DataFrame, ddl: str) -> DataFrame:
    """``df`` with the schema's columns in its order and types; a null in a NOT NULL column raises on writing."""
    columns = []
    for f in struct(ddl).fields:
        c = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if not f.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"null in {f.name}")).cast(f.dataType))
        columns.append(c.alias(f.name))
    return df.select(*columns)


def create_table(name: str, location: str) -> str:
    """DDL of a stored table over the folder that ``state`` writes; ``ALTER TABLE … RECOVER PARTITIONS`` finds new ones."""
    ddl, partitions = TABLES[name]
    keys = ", ".join(x.split(" ")[0] for x in partitions.split(", "))
    return f"CREATE TABLE IF NOT EXISTS {name} ({ddl}, {partitions}) USING parquet PARTITIONED BY ({keys}) LOCATION '{location}'"
