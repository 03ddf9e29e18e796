"""Bindings of the operators to the driver's tables, one registered query each.

``registry.REGISTRY`` maps a query name to ``(spark_fn, oracle_sql)``; the
oracle is DuckDB SQL over the same Parquet tables (or ``None`` when the
operator has no SQL equivalent).
"""
