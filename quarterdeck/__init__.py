"""Entity x period x line-item panel analytics as Spark jobs."""
