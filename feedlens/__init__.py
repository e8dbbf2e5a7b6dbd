"""Message-feed analytics as PySpark DataFrame operators.

Operators take and return DataFrames and fit ``df.transform``; the modules under
``functions`` hold column expressions.
"""
