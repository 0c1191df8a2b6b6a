"""DataFrame operators of the lakehouse layers."""
