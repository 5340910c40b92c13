"""tagloom: label feedback posts and keep the grids that show them in step, as Spark jobs."""
