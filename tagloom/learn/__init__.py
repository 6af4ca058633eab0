"""Word vectors, classifiers and sentence taggers."""
