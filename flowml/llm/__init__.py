"""Operators for preparing language-model training data. Nothing else in flowml imports this."""
