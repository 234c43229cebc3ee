"""Model tables and incremental scans."""
