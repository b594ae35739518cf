"""Registered queries, their oracle SQL, and planning helpers."""
