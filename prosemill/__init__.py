"""prosemill: text-corpus preparation and corpus reports as Spark DataFrame operators."""

__version__ = "0.1.0"
