"""DataFrame -> DataFrame transformations, for batch frames and streams alike."""
