"""tidemark: a change-data lakehouse engine expressed as Spark plans."""
