"""The six reports: specifications, building and writing."""
