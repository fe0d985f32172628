"""Product analytics on Apache Spark: event streams in, usage answers out."""
