"""Jobs and building blocks, each a DataFrame -> DataFrame function."""
