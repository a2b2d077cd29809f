"""panelwright: security and firm panel analytics expressed as Spark DataFrame jobs."""
