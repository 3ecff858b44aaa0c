from .keyed import KeyedTable
from .messages import file_messages, kafka_messages, kafka_options
from .tables import (
    keep_in_memory,
    read_json,
    read_json_inferred,
    read_json_variant,
    register_views,
    variant_field,
    variant_schema,
)

__all__ = [
    "KeyedTable",
    "file_messages",
    "kafka_messages",
    "kafka_options",
    "keep_in_memory",
    "read_json",
    "read_json_inferred",
    "read_json_variant",
    "register_views",
    "variant_field",
    "variant_schema",
]
