"""Registered queries over the driver tables and their oracle SQL."""
