"""Typed readers and writers of case artifacts, and a paged REST data source."""
