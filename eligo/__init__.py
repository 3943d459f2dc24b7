"""eligo: rule-curation analytics and corpus operators as Spark DataFrame jobs."""
