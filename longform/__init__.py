"""Landing and standardising tabular files whose schema cannot be trusted."""
