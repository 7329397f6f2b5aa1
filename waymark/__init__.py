"""Waymark: web, signup and campaign attribution analytics as Spark jobs."""
