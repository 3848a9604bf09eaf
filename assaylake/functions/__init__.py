"""Column functions: text clean-up and lenient casts."""
