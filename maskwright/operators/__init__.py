"""DataFrame operators: pairing, ordering, tensors, metrics, checks, publishing."""
