"""Customer behaviour analytics for a TV platform, as Spark DataFrame transformations."""
