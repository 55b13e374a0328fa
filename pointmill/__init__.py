"""pointmill: point-cloud classification and corpus preparation as Spark plans."""
