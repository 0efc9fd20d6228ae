"""Small-RNA sequencing analytics as Spark DataFrame jobs."""
