"""Readers, writers and the domain tables derived from the star schema."""
