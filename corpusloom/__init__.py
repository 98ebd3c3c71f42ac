"""Corpus curation, dataset building and evaluation roll-ups as Spark plans."""
