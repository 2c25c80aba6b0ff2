"""netpulse: cell-network telemetry analytics written for PySpark."""
