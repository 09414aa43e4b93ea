"""threadloom: corpus engineering for threaded text, written for Spark."""
