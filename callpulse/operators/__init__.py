"""DataFrame operators, the same for tables, streams and micro-batches."""
