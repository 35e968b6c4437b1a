"""Operators for preparing text corpora for model training.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries
(:mod:`framelake.llm.catalog`) when the folder is present.
"""
