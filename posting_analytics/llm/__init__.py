"""Training-data operators: search, scoring, mixing, extraction and near duplicates.

Nothing outside this package imports it; ``queries`` lists its registered
queries, and the pipeline over ``documents`` is ``corpus_pipeline.py`` at the
top of the repository.
"""
