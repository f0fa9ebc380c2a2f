"""Subscription analytics as Spark DataFrame programs: bronze -> silver -> gold."""
