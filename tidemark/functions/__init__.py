"""Column expressions that are safe under ANSI mode."""
