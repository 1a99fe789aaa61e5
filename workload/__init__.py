"""Maps the driver's tables onto the library's inputs and registers the queries."""
