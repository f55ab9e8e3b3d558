"""Composite plans: calendar dimensions, star build, load, reports, test suite."""
