"""A PySpark-native engine for evaluating tabular records with a language-model judge."""

__version__ = "0.1.0"
