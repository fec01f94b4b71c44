"""The same semantics on streams: landing, deduplication, windows, idle state, upserts per batch."""
