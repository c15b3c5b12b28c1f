"""Column expressions and schema-driven column selection."""
