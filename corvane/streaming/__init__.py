"""Linking of arriving records."""
