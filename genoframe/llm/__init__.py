"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage; its queries are listed in
``genoframe.llm.queries`` and the staged pipeline is ``corpus_pipeline.py``.
"""
