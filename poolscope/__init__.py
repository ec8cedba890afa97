"""poolscope: batch-pool job monitoring as Spark DataFrame, SQL and streaming operators."""

__version__ = "0.1.0"
