"""A banking medallion warehouse expressed as Spark DataFrame plans."""
