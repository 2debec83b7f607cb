"""Recruitment-spend analytics and budget allocation as Spark DataFrame operators."""
