"""DataFrame operators: profiling, labels, lemmas, features, models, metrics."""
