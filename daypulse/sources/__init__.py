"""Inputs: tables, app-log parsing/routing, and the test-data mapping."""
