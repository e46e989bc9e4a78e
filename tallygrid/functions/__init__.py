"""Column expressions (all built-in, all inside whole-stage codegen)."""
