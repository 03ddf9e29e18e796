from tessera.sources.tables import TABLES, load_table, register_tables, spread  # noqa: F401
