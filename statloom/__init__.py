"""Statistical analytics and feature preparation as lazy Spark DataFrame operators."""
