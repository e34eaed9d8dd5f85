"""Incremental loading of trip files as they arrive."""
