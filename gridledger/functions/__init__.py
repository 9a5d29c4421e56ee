"""Column functions: business rules and parsing of paths and JSON text."""
