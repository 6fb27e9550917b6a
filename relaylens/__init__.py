"""Service-call telemetry analytics expressed as Spark DataFrame plans."""
