"""The reports on the driver's star-schema tables: model tables, queries and their SQL counterparts."""
