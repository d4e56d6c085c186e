"""Training-data operators: tokens, near-duplicates, licences, packing, repeated
passages, benchmark leaks, language, personal data, quality and archives.

Each module holds one operator with a general interface; ``registry`` holds
the ``opN_*`` queries over the test tables and their SQL. Nothing outside
this package imports it (``corpus_pipeline.py`` counts as part of it).
"""
