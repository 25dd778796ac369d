"""lathe: feature pipelines, splits, regression training and evaluation on Spark.

Every operator is a DataFrame -> DataFrame function or a ``fit`` that runs
distributed aggregates and returns small statistics applied as literals.
"""

__version__ = "0.1.0"
