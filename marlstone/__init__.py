"""A Spark-first analytics engine: governed batches, dimensions, facts, metrics and publications as DataFrame operators."""
