"""Layered (bronze, silver, gold) rating analytics expressed as Spark DataFrame jobs."""
