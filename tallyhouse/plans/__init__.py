"""Definitions that are larger than one operator: metric views, table refresh, lineage cuts."""
