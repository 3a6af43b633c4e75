"""Column expressions. All are built from Spark functions; none needs a UDF."""
