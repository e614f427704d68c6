"""Training-data operators: deduplication, filtering, archives and tokenising as Spark jobs.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.  Every
operator takes DataFrames and returns DataFrames; ``queries.py`` holds the thin
``opN_*`` queries and their SQL.
"""
