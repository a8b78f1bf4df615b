"""Operators: DataFrame in, DataFrame out, lazy, fit for DataFrame.transform."""
