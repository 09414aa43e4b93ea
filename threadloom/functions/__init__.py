"""functions of threadloom."""
