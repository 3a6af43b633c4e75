"""DataFrame-to-DataFrame steps the reports are made of."""
