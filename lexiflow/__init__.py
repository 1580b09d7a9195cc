"""lexiflow: text classification pipelines (prepare, featurize, classify, evaluate, tune) on Spark."""

__version__ = "0.1.0"
