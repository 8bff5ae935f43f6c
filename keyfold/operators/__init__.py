"""Table-level operators on keyed logs."""
