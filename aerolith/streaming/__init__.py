"""Loading Bronze and Silver from a folder that files keep arriving in."""
