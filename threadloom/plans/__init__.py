"""plans of threadloom."""
