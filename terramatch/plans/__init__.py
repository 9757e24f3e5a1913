"""Whole stages of the pipeline, and the queries of this repository."""
