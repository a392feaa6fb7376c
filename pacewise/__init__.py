"""Travel-time reliability analytics as composable Spark DataFrame transformations."""
