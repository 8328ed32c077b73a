"""Registered queries, their derived tables and their SQL oracles."""
