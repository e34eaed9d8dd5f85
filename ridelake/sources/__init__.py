"""Readers for raw files, layers and catalog tables."""
