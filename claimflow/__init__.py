"""Claim and policy analytics as Spark DataFrame transformations."""
