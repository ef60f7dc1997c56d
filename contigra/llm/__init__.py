"""Training-data operators: sharding, packing, filtering, scoring and de-duplication of text.

Nothing outside this subpackage imports it.  Every operator takes and returns
DataFrames; what it must keep between jobs goes to the folder that
``spark.checkpoint.dir`` names, never to a folder of one machine.
"""
