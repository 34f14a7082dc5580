"""Reading, ingesting, storing and generating the star schema."""
