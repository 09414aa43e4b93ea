"""streaming of threadloom."""
