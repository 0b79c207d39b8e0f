"""corpusmill: a Spark-native engine for preparing large text corpora."""

__version__ = "0.1.0"
