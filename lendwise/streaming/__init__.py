"""Structured Streaming entry points (stage 1 of the pipeline on arriving files)."""
