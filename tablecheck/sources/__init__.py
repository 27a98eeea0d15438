"""Where the two sides of a comparison come from."""

from .inventory import INVENTORY_COLUMNS, load_inventory, missing_columns
from .tables import load_jdbc, load_query, load_table, load_with_footers, schema_catalog

__all__ = [
    "INVENTORY_COLUMNS",
    "load_inventory",
    "load_jdbc",
    "load_query",
    "load_table",
    "load_with_footers",
    "missing_columns",
    "schema_catalog",
]
