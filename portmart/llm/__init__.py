"""Operators for training-data pipelines, one module each; ``queries`` registers them.

Nothing outside this subpackage imports it, but for the guard in ``__spark_entry__`` and
``corpus_pipeline``.
"""
