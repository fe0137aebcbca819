"""Delivery-fleet analytics as Spark DataFrame operators."""
