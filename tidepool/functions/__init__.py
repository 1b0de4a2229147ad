"""Column-level helpers: parsing, JSON, time conversion, row statistics, rendering."""
