"""Training-data operators: scoring, formatting, deduplication, mixing, PII, decontamination, output.

Nothing outside this subpackage, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
