"""The queries of this project over the star-schema test tables, and the same as SQL."""
