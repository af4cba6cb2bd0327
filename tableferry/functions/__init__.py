"""Column expressions: type mapping, name conversion, value conforming."""
