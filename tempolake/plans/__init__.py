"""Model registry, table storage and the write-audit-publish flow."""
