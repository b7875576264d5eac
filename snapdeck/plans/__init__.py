"""Models, dimensions, star joins, checks, serving queries and the daily job."""
