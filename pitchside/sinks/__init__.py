"""Writers: raw landing, audited append, key-based loads, layered tables."""
