"""Column expressions. Every one is built in to Spark; there is no UDF."""
