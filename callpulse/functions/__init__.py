"""Column functions: call stages, timestamp text, envelopes."""
