"""Readers for corpora, annotations, vectors and model records."""
