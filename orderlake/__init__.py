"""orderlake — a Spark-native bronze/silver/gold lakehouse for retail order feeds.

Every operator is a plain function over DataFrames (or Columns); I/O lives in
``sources``, ``sinks`` and ``streaming``; composite jobs live in ``plans``.
"""

__version__ = "0.1.0"
