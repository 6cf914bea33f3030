"""Column expressions shared by every report."""
