"""Point-of-sale event analytics as Spark DataFrame transformations."""
