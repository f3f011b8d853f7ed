"""Column expressions: text, header and unit functions. All of them stay on the JVM."""
