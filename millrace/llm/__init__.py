"""Training-data operators: thirteen corpus operators and the queries that apply them.

Nothing outside this folder, ``corpus_pipeline.py`` and the guarded import in
``__spark_entry__.py`` depends on it.
"""
