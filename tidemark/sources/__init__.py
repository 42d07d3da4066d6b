"""Readers: layered datasets, and the five logical sources over the test tables."""
