"""Test-data bridge and SQL twins of the registered queries."""
