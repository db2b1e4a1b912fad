"""Adapters from the test tables, the query catalogue and the report bundle."""
