"""Data-dictionary extraction, modelling and reconciliation as Spark DataFrame jobs."""
