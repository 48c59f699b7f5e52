"""Operators of a training-data pipeline (near-duplicate search, extraction, packing ...).

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
