"""Spark-native data quality, feature and model-validation toolkit.

Everything is a plain ``DataFrame -> DataFrame`` function (or a ``Column``
builder) over public Spark APIs; jobs and streams are thin compositions.
"""

__version__ = "0.1.0"
