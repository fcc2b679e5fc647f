"""railyard — a Spark-native engine for public-transit real-time feeds.

Every operator is a plain, column-parameterised function over DataFrames
(or Columns); the transit refresh (reference tables -> silver -> gold) is
one instantiation of them. Nothing here wraps DataFrames in classes or
runs Python per row: the work is expressed with the DataFrame API so
Catalyst can prune, push down and plan it.
"""

__version__ = "0.1.0"
