"""Operators beyond plain DataFrame calls: ranking, mentions, quality, incremental rebuilds."""
