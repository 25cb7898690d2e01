"""Importing this package registers every query."""

from tristrata.plans.queries import bronze, gold, quality, silver, storage, streams, upserts

__all__ = ["bronze", "gold", "quality", "silver", "storage", "streams", "upserts"]
