"""Where tables come from and where datasets go."""
