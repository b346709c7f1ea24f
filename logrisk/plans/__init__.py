"""Stages put together: the batch job, rendered logs and the registered queries."""
