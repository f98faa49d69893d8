"""Surveys as a stream: landed batches, the live snapshot, current metrics."""
