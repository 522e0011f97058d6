"""Daily environmental-exposure estimates on a hexagonal grid, as Spark DataFrame jobs."""
