"""Spark jobs that turn a web-crawl extraction into clean tables and a small knowledge base."""
