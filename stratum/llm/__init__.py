"""Training-data operators: scoring, cleaning, deduplication and mixing of document corpora.

Nothing outside this subpackage imports it.  Each operator takes DataFrames and returns DataFrames;
``queries`` and ``oracle_sql`` of :mod:`stratum.llm.registry` bind them to the standard tables.
"""
