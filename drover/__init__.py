"""Market and price-risk analytics as Spark DataFrame operators."""
