"""Landed pages and tables in; CSV, change files and reports out."""
