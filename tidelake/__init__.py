"""tidelake: a market and macro-economic lakehouse built from Spark DataFrame plans."""

__version__ = "0.1.0"
