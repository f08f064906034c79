"""Whole queries: the dashboard and the registered queries over the test tables."""
