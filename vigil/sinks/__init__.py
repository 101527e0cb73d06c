"""Writers: protected shards, reject/manifest tables, CSV export."""
