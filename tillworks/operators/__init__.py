"""Relational building blocks shared by the staging tables, the business tables and the data checks."""
