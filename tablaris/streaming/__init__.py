"""The row-local operators applied to streams."""
