"""The library's operators bound to the given tables, with equal SQL."""
