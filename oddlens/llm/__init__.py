"""Corpus operators for training data, and their queries over the test tables."""
