"""Column helpers: every function takes and returns Column, no Python code runs per row."""
