"""Operators of a training-data pipeline over `documents`, `pages`, `benchmark` and `embeddings`.

Nothing outside this subpackage (and `corpus_pipeline.py`) imports it.
"""
