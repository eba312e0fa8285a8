"""Order recommendations and customer similarity as Spark jobs."""
