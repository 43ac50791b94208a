"""Registered queries (one per SURVEY 2 operator group) and their SQL oracles."""
