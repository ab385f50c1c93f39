"""DataFrame -> DataFrame building blocks over the long panel."""
