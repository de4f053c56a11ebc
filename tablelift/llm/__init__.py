"""Operators of a training-data pipeline: dedup, quality, tokenizing, packing, formatting.

Self-contained: nothing outside this package imports it. ``queries.py`` registers one query
per operator; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
