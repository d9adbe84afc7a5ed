"""Batch and streaming data jobs for hospital, insurance and device data on Spark."""
