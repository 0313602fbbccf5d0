"""Operators for training-data pipelines: de-duplication, scoring, packing, archives.

Nothing else in the library imports this subpackage. ``queries.QUERIES`` and
``queries.ORACLES`` hold its registered queries.
"""
