"""Finished jobs: fact tables, business questions, insights and the layered batch run."""
