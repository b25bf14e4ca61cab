"""Price-index engine on Spark: quotes in, official-statistics-style index series out."""
