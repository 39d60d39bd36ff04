"""Analytics of network optics as Spark DataFrame jobs."""
