"""Operators of a training-data pipeline: deduplication, filters, scoring, mixing.

Each module holds one operator with its own general interface;
:mod:`tessera.llm.queries` applies them to the given tables.
"""
