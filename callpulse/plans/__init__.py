"""Named queries over a folder of tables, and the SQL they must agree with."""
