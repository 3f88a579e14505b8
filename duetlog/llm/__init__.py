"""Training-data operators: language identification, personal data, substring
and near-duplicate removal, sharding, quality rules, piece encoding,
benchmark decontamination, web archives and main-text extraction.

Nothing outside this package imports it; ``queries.py`` lists the registered
queries and ``corpus_pipeline.py`` at the repository top chains five of them.
"""
