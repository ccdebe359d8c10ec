"""Operators from documents to a graph: chunking, extraction, resolution, validation, graph upserts, evaluation."""
