"""transfero: legacy back-office records migrated and reconciled as Spark DataFrame jobs."""
