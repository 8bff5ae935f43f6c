"""Operators that prepare text for training language models.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; ``queries`` registers each over its whole test table.
"""
