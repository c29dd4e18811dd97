"""Column expressions, all JVM-side but for the Arrow similarity function."""
