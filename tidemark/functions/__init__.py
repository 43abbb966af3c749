from tidemark.functions.calendar import date_dimension, date_dimension_of, date_parts, iso_weekday
from tidemark.functions.keys import (
    case_map,
    detail_hash_key,
    key_bucket,
    key_number,
    key_suffix,
    name,
    names,
    row_checksum,
    source_id,
    surrogate_key,
    surrogate_key_name,
    system_id_lookup,
    with_surrogate_key,
)

__all__ = [
    "case_map",
    "date_dimension",
    "date_dimension_of",
    "date_parts",
    "detail_hash_key",
    "iso_weekday",
    "key_bucket",
    "key_number",
    "key_suffix",
    "name",
    "names",
    "row_checksum",
    "source_id",
    "surrogate_key",
    "surrogate_key_name",
    "system_id_lookup",
    "with_surrogate_key",
]
