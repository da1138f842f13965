"""Masking, erasure and evidence for personal data, written as Spark jobs."""
