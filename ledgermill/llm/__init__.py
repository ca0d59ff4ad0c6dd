"""Operators for building training corpora: filtering, deduplication, mixing, search, extraction and tokenization.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
