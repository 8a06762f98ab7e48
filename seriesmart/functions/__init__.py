"""Column expressions. Everything here stays inside Catalyst; there is no Python UDF."""
