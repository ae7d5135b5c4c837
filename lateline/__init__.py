"""Delivery-risk and profitability analytics over order-line tables, as Spark jobs."""
