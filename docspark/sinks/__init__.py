"""Writers for finished records and their load log."""
