"""Whole analyses, and the queries the repository is checked by."""
