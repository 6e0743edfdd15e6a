"""Retail analytics as Spark DataFrame jobs: bronze to silver to gold, KPIs, checks, streams."""
