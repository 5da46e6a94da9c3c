from storelens.sources.tables import TABLE_NAMES, Tables, read_table

__all__ = ["TABLE_NAMES", "Tables", "read_table"]
