"""DataFrame -> DataFrame stage operators of the extracts."""
