"""Writers for corpora, annotations, scores and model records."""
