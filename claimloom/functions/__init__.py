"""Column functions: everything here maps columns to columns without a shuffle."""
