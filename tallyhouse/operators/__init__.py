"""DataFrame-to-DataFrame operators over the star schema."""
