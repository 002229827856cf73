"""Composed plans: the lazy stage graph, the materialising job, the query registry."""
