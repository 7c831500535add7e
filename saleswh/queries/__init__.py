"""Named queries over the retail and event tables, and their SQL counterparts."""
