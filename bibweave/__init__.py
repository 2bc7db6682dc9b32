"""bibweave: record linkage and corpus preparation as ordinary Spark DataFrame plans."""
