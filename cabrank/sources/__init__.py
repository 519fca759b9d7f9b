"""Sources: CSV files, monthly file sets, lake tables and catalog tables."""
