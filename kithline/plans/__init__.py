"""Whole linkage plans and their command line."""
