"""A PySpark engine for clickstream analytics: ingest, validation, deduplication, lateness, minute metrics, carts, features, catalog and serving."""
