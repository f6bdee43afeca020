"""Live service figures of a call centre, on Spark tables and streams."""
