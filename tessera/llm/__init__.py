"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``embeddings``.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; ``queries`` binds them to the test
tables.
"""
