"""Funnel and cohort analytics as composable Spark DataFrame operators."""
