"""The four batch jobs."""
