"""Relational operators: cleaning, chunking, retrieval, ranking, evaluation, normalisation."""
