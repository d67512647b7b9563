"""Declarative feature tables, feature selection and k-fold scoring on Spark DataFrames."""
