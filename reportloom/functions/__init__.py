"""Column-level building blocks: Column in, Column out, all inside code generation."""
