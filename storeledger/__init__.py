"""Retail sales lakehouse operators for PySpark.

Every public function takes and returns Spark DataFrames; reading, writing and
raising happen only in ``sources``, ``sinks`` and ``plans``.
"""

__version__ = "0.1.0"
