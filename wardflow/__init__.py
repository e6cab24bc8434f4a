"""wardflow: hospital operations analytics expressed as Spark DataFrame plans."""
