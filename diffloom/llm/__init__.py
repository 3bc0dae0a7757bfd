"""Training-data operators: one module per operator, with the queries in ``queries.py`` and the
registry in ``catalog.py``. Nothing outside this folder imports it but ``__spark_entry__.py``
and ``corpus_pipeline.py``."""
