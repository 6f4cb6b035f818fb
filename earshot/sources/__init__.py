"""Text scans and line parsing."""
