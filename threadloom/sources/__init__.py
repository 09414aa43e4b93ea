"""sources of threadloom."""
