"""Structured Streaming jobs over the patient device readings."""
