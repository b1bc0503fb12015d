"""``DataFrame -> DataFrame`` operators; each returns one lazy plan."""
