"""The incremental runs: files are taken as they arrive."""
