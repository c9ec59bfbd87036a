"""Versioned wide-column data as plain DataFrames."""
