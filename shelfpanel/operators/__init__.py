"""DataFrame building blocks. None of them collects rows or runs Python per row."""
