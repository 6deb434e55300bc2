"""Column expressions shared by the transforms."""
