"""Column expressions: Column in, Column out, built-ins only."""
