"""Operators for building training corpora (see README, "Training-data operators").

Nothing outside this package imports it, except the guarded hook in
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
