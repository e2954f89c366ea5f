"""Operators of a training-data pipeline over documents, pages and vectors.

One module per operator; ``queries`` registers the ``opN_*`` queries and
their SQL. Nothing outside this subpackage (and ``corpus_pipeline.py``)
imports it.
"""
