"""Named queries over the star-schema tables."""
