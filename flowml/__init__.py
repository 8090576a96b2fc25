"""flowml: Spark-native preparation, balancing, modelling and scoring of labelled flow records."""

__version__ = "0.1.0"
