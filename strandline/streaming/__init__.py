"""Structured Streaming forms of the binning operators."""
