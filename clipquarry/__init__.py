"""Curation and benchmarking of transcribed audio clips on Spark."""
