"""Inkwright: restoring and modernising scanned-book text with Spark DataFrames."""
