"""Weftline: text-to-knowledge-graph operators written as Spark DataFrame plans."""
