"""Operations of a large-scale training-data pipeline.

One module per operator; nothing outside this package imports it.  The
registered queries are in :mod:`lodestar.llm.queries`.
"""
