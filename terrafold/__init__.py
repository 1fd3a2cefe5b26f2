"""Land-cover history analytics on Spark: sparse raster cells, row spans and latitude-true areas as DataFrames."""
