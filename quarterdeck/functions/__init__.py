"""Column expressions: periods, text and numbers. Everything stays on the JVM side."""
