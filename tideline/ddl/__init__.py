"""Data definition statements of MySQL's dialect, and the schemas that they make."""
