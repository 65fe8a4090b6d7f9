"""Specifications, the migration state machine, the runner and reports."""
