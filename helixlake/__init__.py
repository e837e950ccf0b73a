"""helixlake: genomic-surveillance evidence analytics expressed as PySpark jobs."""
