"""Column expressions shared by the operators (time buckets, exact price arithmetic)."""
