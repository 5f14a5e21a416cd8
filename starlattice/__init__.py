"""Star-schema loads, cube lattices and dashboards as plain Spark jobs."""
