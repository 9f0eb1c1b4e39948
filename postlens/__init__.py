"""postlens: Spark jobs for labelled social posts (ingest, clean, enrich, index, report)."""
