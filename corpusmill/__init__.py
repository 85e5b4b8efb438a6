"""A document-corpus engine expressed as Spark DataFrame plans."""
