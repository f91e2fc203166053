"""Real-time feed: binary codec, flattening, stream jobs and upsert sink."""
