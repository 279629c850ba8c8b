"""evenkeel: compare, synchronise and reconcile tables with Spark."""
