"""Whole plans: the adapter of the driver's tables, registered queries, and the pipeline."""
