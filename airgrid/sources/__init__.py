"""Reading inputs and writing results; every path may be any storage Spark can reach."""
