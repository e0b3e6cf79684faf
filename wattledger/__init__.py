"""Revenue assurance for metered infrastructure, written as Spark DataFrame operators."""
