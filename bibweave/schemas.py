"""Schemas of the tables that the linkage reads and publishes."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

METADATA = "id string, title string, abstract string, clean_doi string, year bigint, last_names array<string>, references string, dataset string"
NORMALISED = f"{METADATA}, title_norm string, abstract_norm string, last_names_norm string"
_LID = ", ".join(f"{f}_cld2_lid_success boolean, {f}_cld2_lid_is_reliable boolean, {f}_cld2_lid_first_result string, {f}_cld2_lid_first_result_short_code string" for f in ("title", "abstract"))
METADATA_WITH_LID = f"{METADATA}, {_LID}"
PAIRS = "id1 string, id2 string"
ID_MAPPING = "merged_id string not null, orig_id string not null"
SOURCES = "merged_id string not null, orig_id string not null, dataset string not null"
REFERENCES = "merged_id string not null, ref_id string not null"

#: Descriptions that are published with the tables.
DESCRIPTIONS = {
    "all_metadata_with_cld2_lid": "Metadata of all articles that take part in the linkage, with language tags.",
    "sources": "The merged id of each original id, and the catalogue it comes from.",
    "references": "The merged ids that each merged id cites.",
}

_TYPES = {"STRING": StringType, "INTEGER": LongType, "INT64": LongType, "BOOLEAN": BooleanType, "BOOL": BooleanType, "FLOAT": DoubleType, "FLOAT64": DoubleType, "TIMESTAMP": TimestampNTZType}


def struct_of(fields: list[dict]) -> StructType:
    """A warehouse's JSON schema (name, type, mode, fields, description) as a Spark schema."""
    out = []
    for f in fields:
        kind = f["type"].upper()
        value = struct_of(f["fields"]) if kind in ("RECORD", "STRUCT") else _TYPES[kind]()
        mode = f.get("mode", "NULLABLE").upper()
        if mode == "REPEATED":
            value = ArrayType(value, False)
        note = {"comment": f["description"]} if f.get("description") else {}
        out.append(StructField(f["name"], value, mode != "REQUIRED", note))
    return StructType(out)
