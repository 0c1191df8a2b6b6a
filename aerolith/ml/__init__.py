"""Training and judging delay models on the feature table."""
