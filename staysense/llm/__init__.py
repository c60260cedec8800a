"""Operators of a training-data pipeline: filters, dedup, mixing, scoring, tokenising.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
