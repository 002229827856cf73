"""DataFrame -> DataFrame operators: split, clean, quarantine, score, views, audits."""
