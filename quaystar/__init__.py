"""A dimensional warehouse for e-commerce order data, written as Spark DataFrame jobs."""
