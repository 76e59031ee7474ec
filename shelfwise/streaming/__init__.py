"""Micro-batch ETL on Structured Streaming."""
