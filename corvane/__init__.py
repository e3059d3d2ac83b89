"""Search, record linkage and pair-text jobs written as Spark DataFrame plans."""

__version__ = "0.1.0"
