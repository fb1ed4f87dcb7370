"""Operators of a training-data pipeline: deduplication, joins, tokens, models.

Each module holds one operator with a general ``DataFrame -> DataFrame``
interface; ``queries`` registers one query per operator over the given tables.
Nothing else in the library imports this subpackage.
"""
