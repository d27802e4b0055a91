"""Column expressions that stay inside whole-stage code generation."""
