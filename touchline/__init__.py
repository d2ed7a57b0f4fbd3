"""Football event analytics as Spark jobs: feeds, layers, models, reports and streams."""
