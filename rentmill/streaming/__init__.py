from rentmill.streaming.ingest import ingest_new_files, read_ingested, read_rejected

__all__ = ["ingest_new_files", "read_ingested", "read_rejected"]
