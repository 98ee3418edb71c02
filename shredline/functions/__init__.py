"""Column expressions and fixed field specifications."""
