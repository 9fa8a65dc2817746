"""docketry: corporate-speech corpus processing as Spark DataFrame plans."""
