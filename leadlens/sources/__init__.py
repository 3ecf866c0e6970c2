"""Readers, writers and derived source tables."""
