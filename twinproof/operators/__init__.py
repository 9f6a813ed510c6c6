"""DataFrame in, DataFrame out. Nothing here collects data to the driver."""
