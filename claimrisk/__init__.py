"""Provider billing-risk analytics as Spark DataFrame and SQL transformations."""
