"""A PySpark engine for partitioning large labelled volumes and the graphs derived from them."""
