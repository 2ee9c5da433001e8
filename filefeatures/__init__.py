"""Folders of delimited files in, feature tables and predictions out, on Spark."""
