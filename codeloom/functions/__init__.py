"""Row-level Column helpers."""
