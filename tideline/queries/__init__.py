"""The pipeline on the given tables: each query has a Spark form and an independent SQL form."""
