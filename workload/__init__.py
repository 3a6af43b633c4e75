"""The reports run on the star-schema test tables, and their SQL counterparts."""
