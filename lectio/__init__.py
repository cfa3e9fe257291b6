"""Spark jobs for timed transcripts, retrieval and verified citations."""
