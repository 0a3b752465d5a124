"""Column expressions. Every function takes and returns Spark columns; none of them is a UDF."""
