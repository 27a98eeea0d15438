"""Column expressions: the text, hash and JSON forms of values, rows and keys."""

from .hashing import key_text, row_hash, row_text, value_text
from .json import details_json, key_json, light_details
from .keys import normalise_keys, restore_binary_keys
from .names import field, fields, literal, quoted

__all__ = [
    "details_json",
    "field",
    "fields",
    "key_json",
    "key_text",
    "light_details",
    "literal",
    "normalise_keys",
    "quoted",
    "restore_binary_keys",
    "row_hash",
    "row_text",
    "value_text",
]
