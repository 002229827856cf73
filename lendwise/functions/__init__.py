"""Column-level building blocks: member key, cleaning expressions, bands."""
