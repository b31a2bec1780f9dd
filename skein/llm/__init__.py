"""Operators of a large-scale training-data pipeline (each module one operator).

Nothing else in the library imports this subpackage; ``queries.py`` registers the
``opN_*`` queries and ``corpus_pipeline.py`` (repository top) chains five of them.
"""
