"""Typed readers, column contracts and configuration as data."""
