"""Readers of statement files and writers of tables, reports and manifests."""
