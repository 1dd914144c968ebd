"""marketlake: trade-tick analytics as plain Spark DataFrame operators."""

__version__ = "0.1.0"
