"""Change-data replication and reconciliation as PySpark DataFrame operators."""
