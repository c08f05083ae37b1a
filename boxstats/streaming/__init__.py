"""Structured Streaming over snapshots that arrive one after the other."""
