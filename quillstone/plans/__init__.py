"""Named queries with, where SQL can say it, their SQL."""
