"""Cascata: monthly revenue waterfalls as Spark DataFrame plans."""
