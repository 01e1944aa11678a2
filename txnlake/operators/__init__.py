"""DataFrame operators of the batch lakehouse."""
