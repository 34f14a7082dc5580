"""Tallyhouse: retail analytics from raw tables to a decision, as plain Spark DataFrame functions."""
