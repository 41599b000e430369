"""Operators for large training-data pipelines (WARC, mixing, licences, HTML,
dedup, LM scoring, packing, quality rules).  Nothing outside this folder, the
tests in ``tests/llm`` and ``corpus_pipeline.py`` imports it."""
