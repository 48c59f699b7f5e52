"""Sources: base-table schemas, loaders and the derived test fixture."""

from .tables import SCHEMAS, Tables, catalog_tables, jdbc_tables, load_tables, validate

__all__ = ["SCHEMAS", "Tables", "catalog_tables", "jdbc_tables", "load_tables", "validate"]
