"""cinestar: film-catalogue analytics as plain Spark DataFrame operators."""
