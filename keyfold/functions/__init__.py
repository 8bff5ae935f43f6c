"""Column-level building blocks: no shuffle, all inside code generation."""
