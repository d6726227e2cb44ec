"""DataFrame -> DataFrame transforms, to be chained with `.transform`."""
