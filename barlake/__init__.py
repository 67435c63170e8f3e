"""barlake: daily market bars on Spark, from landed payloads to research universes."""
