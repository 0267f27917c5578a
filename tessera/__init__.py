"""tessera: Spark-native tabular feature and model-evaluation operators."""

__version__ = "0.1.0"
