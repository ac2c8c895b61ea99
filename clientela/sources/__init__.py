"""Reading raw and intermediate tables, publishing score tables."""
