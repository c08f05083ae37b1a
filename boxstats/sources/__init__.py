"""Readers, writers and views that the operators work on."""
