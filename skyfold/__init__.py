"""skyfold: flight-operations analytics as Spark DataFrame operators.

Every operator is a plain function taking and returning DataFrames (or
Columns), parameterised by column names, built from built-in Spark SQL
expressions so that Catalyst can push filters, prune columns and plan
joins and aggregates itself.
"""

__version__ = "0.1.0"
