"""Readers and writers of the native folder layout and of feeds."""
