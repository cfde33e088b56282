"""Operators of a training-data pipeline: archive, quality, duplicates, extraction, filters,
decontamination, tokens and chat formatting.

Nothing else in the library imports this subpackage.  Each module holds one operator with a
general interface; ``queries`` holds the registered queries and their SQL.
"""
