"""Column-level functions: text, types, time and documents."""
