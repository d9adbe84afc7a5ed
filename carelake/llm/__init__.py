"""Operators for corpora of text that language models are trained on."""
