"""Column expressions. Everything here stays inside whole-stage code generation; there is no Python UDF."""
