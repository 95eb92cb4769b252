"""Operators for preparing language-model training corpora.

Nothing outside this package imports it; its queries are in
``zoneflow.llm.queries`` and its end-to-end job in ``corpus_pipeline``.
"""
