"""Sales pipeline analytics as Spark jobs: staging, star schema, wide tables, metrics."""
