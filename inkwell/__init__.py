"""Spark toolkit for corpora of human-written and machine-generated text."""
