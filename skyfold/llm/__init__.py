"""Operators of a large-scale training-data pipeline (deduplication,
decontamination, language ID, sharding, packing, scoring).

Nothing outside this package imports it. Every module states its method,
its parameters and the result for null, empty, repeated and tied rows.
"""
