"""Retail analytics as Spark jobs: tolerant ingestion, typed staging, business tables, dashboards, data checks."""
