"""Readers and writers of keyed logs."""
