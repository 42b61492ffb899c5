"""Cumulative data modelling and analytics on Spark DataFrames.

``operators``  DataFrame in, DataFrame out
``functions``  Column helpers shared by the operators
``sources``    readers, table writers, connectors
``streaming``  Structured Streaming jobs
``plans``      the operators applied to the star-schema and events tables
"""

__version__ = "0.1.0"
