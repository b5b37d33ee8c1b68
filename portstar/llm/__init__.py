"""Operators for building training corpora at scale.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it. Each module holds one
operator with a general interface over any DataFrame; ``queries.py`` applies them to the test
tables under the names ``op1_...`` to ``op13_...``.
"""
