"""Corpus operators for training-data pipelines; nothing else in helixframe imports this."""
