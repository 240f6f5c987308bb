"""Tidemill: landing, accounting for and reading time series with Spark."""
