"""Corpus tagging and tagger evaluation as Spark jobs."""
