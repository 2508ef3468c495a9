"""Spark jobs for competition records: parsing, running records, enrichment, matching, ratings and reports."""
