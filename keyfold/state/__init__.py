"""Definitions of keyed state collections."""
