"""Column expressions shared by every stage; all of them are built-in Spark functions."""
