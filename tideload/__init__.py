"""Change capture, warehouse loading and billing jobs as Spark DataFrame operators."""
