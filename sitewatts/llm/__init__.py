"""Operators for preparing language-model training data.

Nothing outside this folder and ``corpus_pipeline.py`` imports it. Each module
holds one operator with a general interface and, at its end, the registered
query that applies it to the whole tables with production parameters.
"""
