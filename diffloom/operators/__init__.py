"""DataFrame -> DataFrame operators grouped by the work they do (logs, grading, patches, ...)."""
