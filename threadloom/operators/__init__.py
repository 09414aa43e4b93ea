"""operators of threadloom."""
