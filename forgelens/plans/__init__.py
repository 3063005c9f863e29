"""Relations: one function per table of the star schema."""
