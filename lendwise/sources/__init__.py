"""Sources, sinks and catalog registration (CSV and parquet only, as the reference)."""
