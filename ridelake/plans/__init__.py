"""Whole results: the Silver table, the star schema, indicators and profiles."""
