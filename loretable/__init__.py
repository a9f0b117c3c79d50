"""Spark jobs that turn large collections of long text into a queryable knowledge base."""
