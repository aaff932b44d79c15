"""The operators bound to the driver's test tables, with their SQL counterparts."""
