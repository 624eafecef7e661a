"""Event correlation and anomaly scoring as Spark DataFrame operators."""
