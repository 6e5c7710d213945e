"""DataFrame transformations: frames in, one lazy frame out."""
