"""The load steps and the queries over the star schema."""
