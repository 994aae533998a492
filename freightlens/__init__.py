"""Supply-chain order-item analytics expressed as Spark DataFrame jobs."""
