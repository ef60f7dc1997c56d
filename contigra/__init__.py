"""A PySpark engine for genome-resolved sequence data: contigs, depths, graphs, bins and their quality."""
