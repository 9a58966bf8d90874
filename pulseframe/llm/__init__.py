"""Operators for preparing language-model training data.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
