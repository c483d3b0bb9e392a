"""Operators for preparing language-model training data, each a function over DataFrames."""
