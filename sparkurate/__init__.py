"""A PySpark engine that turns human-written item lists into a clean, deduplicated catalog."""
